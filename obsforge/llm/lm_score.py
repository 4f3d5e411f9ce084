"""Masked pseudo-likelihood: a small network predicts each word from the words on both sides; log-probabilities are summed.

The vocabulary comes from word counts over all documents: every word found MIN_COUNT times has an id of its own, the most frequent
first, up to the size of an id (two bytes); the others share hashed ids. A prediction descends a tree of 32 branches a node: two
steps reach the hashed ids, the most frequent words and the clusters of 1,024 words each; two more the words of a cluster. The
network is trained in numpy, in every task on its part of the corpus; after each round the parameters are averaged in Spark,
weighted by the words a task has learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified, steps, utf8, word_hashes
from obsforge.session import written

GROUP = 32
HEAD = 961  # ids that two steps reach; the other nodes there are clusters
CLUSTER = GROUP * GROUP
CLUSTERS = GROUP * GROUP - HEAD
IDS = HEAD + CLUSTERS * CLUSTER  # at most; below 2 ** 16
RARE = 64  # ids that words without one of their own share by hash
WORDS = IDS - RARE  # words with an id of their own, at most
MIN_COUNT = 5
SIDE = 2  # words read on each side
EMBEDDING, HIDDEN = 16, 32
ROUNDS = 3
FIRST_BATCH, LAST_BATCH, RATE, SQUARES = 256, 8192, 0.05, 1e-6
STEP_WORDS = 1 << 15
BLOCK = 1 << 14  # parameters that a row of an average holds
TASK_WORDS = 1 << 21  # smaller partitions are trained together: every task sends its changes of the parameters


def _shapes(clusters: int) -> dict[str, tuple[int, ...]]:
    """Parameters of a network with so many clusters. Two steps share one matrix (near: group and member, far: branch and leaf);
    a step has a bias for every node it may start from and, but for the first, the node's code is added to what it reads."""
    return {
        "inner": (2 * SIDE * EMBEDDING, HIDDEN), "inner_bias": (HIDDEN, 1),
        "near": (2 * GROUP, HIDDEN), "far": (2 * GROUP, HIDDEN),
        "group_bias": (GROUP, 1), "member_bias": (GROUP, GROUP), "member_code": (HIDDEN, GROUP),
        "branch_bias": (GROUP, clusters), "branch_code": (HIDDEN, clusters),
        "leaf_bias": (GROUP, clusters * GROUP), "leaf_code": (HIDDEN, clusters * GROUP),
        "embedding": (HEAD + clusters * CLUSTER + 1, EMBEDDING),
    }


def _size(clusters: int) -> int:
    return sum(int(np.prod(s)) for s in _shapes(clusters).values())


def clusters_for(words: int) -> int:
    """Clusters that a vocabulary of so many words needs."""
    return max(0, -(-(RARE + words - HEAD) // CLUSTER))


def initial(seed: int = 1, clusters: int = CLUSTERS) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    spread = {"inner": 2 * SIDE * EMBEDDING, "embedding": EMBEDDING}
    out = {k: (random.standard_normal(s) * (0.0 if k.endswith("bias") else 1 / np.sqrt(spread.get(k, HIDDEN)))).astype(np.float32) for k, s in _shapes(clusters).items()}
    unused = np.arange(HEAD + clusters, CLUSTER)  # nodes without a cluster get no share
    out["member_bias"][unused % GROUP, unused // GROUP] = -30
    out["group_bias"][np.flatnonzero(np.bincount(unused // GROUP, minlength=GROUP) == GROUP)] = -30
    return out


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([v.ravel() for v in parameters.values()])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _shapes((len(values) - _size(0)) // (_size(1) - _size(0))).items():
        size = int(np.prod(s))
        out[k] = np.array(values[at : at + size], dtype=np.float32).reshape(s)
        at += size
    return out


def contexts(ids: np.ndarray, first: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
    """[word, 2 * SIDE] neighbours, within its document, of every word or of the chosen ones; IDS stands for "beyond the text"."""
    lengths = np.diff(first)
    place = np.arange(len(ids)) + np.repeat(np.arange(len(lengths)) * 2 * SIDE + SIDE, lengths)
    padded = np.full(len(ids) + 2 * SIDE * len(lengths), IDS, dtype=np.uint16)
    padded[place] = ids
    if chosen is not None:
        place = place[chosen]
    return np.stack([padded[place + k] for k in (*range(-SIDE, 0), *range(1, SIDE + 1))], axis=1)


def _path(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node of every id after two steps; which ids go on in a cluster; and their place among the words of all clusters."""
    far = np.flatnonzero(ids >= HEAD)
    beyond = ids[far].astype(np.int64) - HEAD
    node = ids.astype(np.int64)
    node[far] = HEAD + beyond // CLUSTER
    return node, far, beyond


def _share(x: np.ndarray, taken: np.ndarray):
    """Log-probability of the branch taken, and the shares of all branches (in the place of x) with their sums."""
    x -= x.max(axis=0)
    own = x[taken, np.arange(len(taken))]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    return own - np.log(total), total


def _two_steps(p: dict[str, np.ndarray], matrix: str, hidden: np.ndarray, steps_made: list) -> np.ndarray:
    """Log-probability of two steps (name, node started from, branch taken); appends what the gradient needs.

    The matrix times (hidden + code of the node) is its product with hidden plus one with every code, looked up by node.
    """
    both = p[matrix] @ hidden
    logs = 0
    for half, (name, node, taken) in enumerate(steps_made):
        x = both[half * GROUP : (half + 1) * GROUP]
        if node is not None:
            x += (p[f"{name}_bias"] + p[matrix][half * GROUP : (half + 1) * GROUP] @ p[f"{name}_code"]).take(node, axis=1)
        else:
            x += p[f"{name}_bias"]
        own, total = _share(x, taken)
        logs = logs + own
        steps_made[half] = (name, node, taken, total)
    steps_made.append(both)
    return logs


def _walk(p: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray):
    rows = np.minimum(around, len(p["embedding"]) - 1)
    read = p["embedding"].take(rows, axis=0).reshape(len(ids), -1)
    hidden = p["inner"].T @ read.T
    hidden += p["inner_bias"]
    np.maximum(hidden, 0, out=hidden)
    node, far, beyond = _path(ids)
    near_steps = [("group", None, node // GROUP), ("member", node // GROUP, node % GROUP)]
    logs = _two_steps(p, "near", hidden, near_steps)
    walked = [("near", None, hidden, near_steps)]
    if len(far):
        distant = hidden.take(far, axis=1)
        far_steps = [("branch", beyond // CLUSTER, beyond // GROUP % GROUP), ("leaf", beyond // GROUP, beyond % GROUP)]
        logs[far] += _two_steps(p, "far", distant, far_steps)
        walked.append(("far", far, distant, far_steps))
    return logs, (rows, read, hidden, walked)


def forward(p: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray):
    """Log-probability of each word given its neighbours, and the values the gradient needs."""
    return _walk(p, around, ids)


def _summed(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Columns of values added up by `at`."""
    return np.stack([np.bincount(at, weights=v, minlength=size) for v in values]).astype(values.dtype)


def learn(p: dict[str, np.ndarray], squares: dict[str, np.ndarray], around: np.ndarray, ids: np.ndarray) -> None:
    """One step of Adagrad on one minibatch, in place; of the embedding only the rows that were read change."""
    _, (rows, read, hidden, walked) = _walk(p, around, ids)
    n, gradient = len(ids), {}
    at_hidden = None
    for matrix, where, seen_by, (*steps_made, both) in walked:
        codes = np.zeros_like(p[matrix])
        for half, (name, node, taken, total) in enumerate(steps_made):
            part = slice(half * GROUP, (half + 1) * GROUP)
            share = both[part]
            share *= 1 / (total * n)
            share[taken, np.arange(len(taken))] -= 1 / n
            if node is None:
                gradient[f"{name}_bias"] = share.sum(axis=1, keepdims=True)
                continue
            of_nodes = _summed(share, node, p[f"{name}_bias"].shape[1])
            gradient[f"{name}_bias"] = of_nodes
            codes[part] = of_nodes @ p[f"{name}_code"].T
            gradient[f"{name}_code"] = p[matrix][part].T @ of_nodes
        gradient[matrix] = both @ seen_by.T + codes
        back = p[matrix].T @ both
        if where is None:
            at_hidden = back
        else:
            at_hidden[:, where] += back
    at_hidden *= hidden > 0
    gradient["inner"] = read.T @ at_hidden.T
    gradient["inner_bias"] = at_hidden.sum(axis=1, keepdims=True)
    at_read = (at_hidden.T @ p["inner"].T).reshape(-1, EMBEDDING)
    order = np.argsort(rows.ravel(), kind="stable")
    held = rows.ravel().take(order)
    starts = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    of_rows, which = np.add.reduceat(at_read.take(order, axis=0), starts, axis=0), held[starts]
    for k, g in gradient.items():
        squares[k] += g * g
        p[k] -= RATE * g / np.sqrt(squares[k] + 1e-12)
    seen = squares["embedding"].take(which, axis=0) + of_rows * of_rows
    squares["embedding"][which] = seen
    p["embedding"][which] -= RATE * of_rows / np.sqrt(seen + 1e-12)


def vocabulary(docs: DataFrame) -> np.ndarray:
    """Hashes of the words found MIN_COUNT times or more in all documents, at most WORDS, the most frequent first; ties by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part, at in steps(*utf8(batch.column(0)), limit=8 << 20):
                words, counts = np.unique(word_hashes(part, at, lower=True)[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts)], ["word", "n"])

    counts = identified(docs, "text").select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= MIN_COUNT).orderBy(F.desc("n"), "word").limit(WORDS)  # the size of an id bounds this
    return top.select("word").toArrow()["word"].to_numpy().astype(np.int64)


def encoded(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """doc_id, ids: the text as ids of two bytes each; null text has none."""
    order = np.argsort(words)
    ranked = words[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part, at in steps(*utf8(batch.column(1))):
                hashes, first = word_hashes(part, at, lower=True)
                ids = (hashes % np.uint64(RARE)).astype(np.uint16)
                if len(ranked):
                    near = np.minimum(np.searchsorted(ranked, hashes.view(np.int64)), len(ranked) - 1)
                    known = ranked[near] == hashes.view(np.int64)
                    ids[known] = RARE + order[near[known]]
                held = [ids[x:y].tobytes() for x, y in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(held, pa.binary())], ["doc_id", "ids"])

    return identified(docs, "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive documents (from, to, ids, first) of about STEP_WORDS words together."""
    rows = [np.frombuffer(r.as_py() or b"", dtype=np.uint16) for r in batch.column(1)]
    a = 0
    while a < len(rows):
        b, held = a, 0
        while b < len(rows) and (b == a or held + len(rows[b]) <= STEP_WORDS):
            held += len(rows[b])
            b += 1
        yield a, b, np.concatenate(rows[a:b]), np.cumsum([0, *map(len, rows[a:b])])
        a = b


def targets(words: int, turn: int, rounds: int) -> np.ndarray:
    """The words of a stretch that round `turn` learns from; over all rounds every word is a target once."""
    return np.arange(turn, words, rounds)


def _trained(start: np.ndarray, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shaped(start)
        squares = {k: np.full(v.shape, SQUARES, dtype=np.float32) for k, v in p.items()}
        seen = 0
        for batch in batches:
            for _, _, ids, first in _stretches(batch):
                chosen = targets(len(ids), turn, rounds)
                if not len(chosen):
                    continue
                chosen = np.random.default_rng(seen + turn).permutation(chosen)
                around, words = contexts(ids, first, chosen), ids[chosen]
                at = 0
                while at < len(chosen):
                    size = min(LAST_BATCH, max(FIRST_BATCH, seen // 16))  # small steps first, larger ones with what was learned
                    learn(p, squares, around[at : at + size], words[at : at + size])
                    seen += len(words[at : at + size])
                    at += size
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([flat(p)], pa.list_(pa.float32())), pa.array([float(seen)])], ["parameters", "weight"])

    return run


def _blocks(run, start: np.ndarray):
    """What a task changed in the parameters, times its weight, in blocks; words it has not seen leave zeros, which compress."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            values, weight = batch["parameters"].flatten().to_numpy() - start, batch["weight"][0].as_py()
            for b, at in enumerate(range(0, len(values), BLOCK)):
                change = values[at : at + BLOCK] * np.float32(weight)
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([change.tobytes()]), pa.array([weight])], ["block", "total", "weight"])

    return blocks


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of a partition with those of one number added up."""
    held: dict[int, list] = {}
    for batch in batches:
        for block, total, weight in zip(*(c.to_pylist() for c in batch.columns)):
            values = np.frombuffer(total, dtype=np.float32).astype(np.float64)
            before = held.get(block)
            held[block] = [values, weight] if before is None else [before[0] + values, before[1] + weight]
    for block, (values, weight) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([values.tobytes()]), pa.array([weight])], ["block", "total", "weight"])


def train(ids: DataFrame, rounds: int = ROUNDS, clusters: int = CLUSTERS) -> np.ndarray:
    """Flat parameters after `rounds` rounds over the encoded corpus; the initial ones if it has no words."""
    values, schema = flat(initial(clusters=clusters)), "block int, total binary, weight double"
    held = ids.agg(F.sum(F.octet_length("ids")).alias("bytes")).first()["bytes"] or 0
    ids = ids.coalesce(max(ids.sparkSession.sparkContext.defaultParallelism, held // 2 // TASK_WORDS))
    for turn in range(rounds):
        tasks = ids.mapInArrow(_blocks(_trained(values, turn, rounds), values), schema)
        rows = tasks.repartition("block").mapInArrow(_added, schema).collect()  # the blocks of one set of parameters
        if rows:
            change = np.concatenate([np.frombuffer(r["total"]) / r["weight"] for r in sorted(rows, key=lambda r: r["block"])])
            values = (values + change).astype(np.float32)
    return values


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over all words), mean_log_probability for every row of (doc_id, text, any other columns).

    Null and empty texts have no words, sum 0 and a null mean. Repeated rows repeat their score (and count in training); an
    empty table gives no rows.
    """
    words = vocabulary(docs)
    ids = written(encoded(docs, words), "encoded")
    values = train(ids, rounds, clusters_for(len(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shaped(values)
        for batch in batches:
            for a, b, words, first in _stretches(batch):
                sums = np.append(0.0, np.zeros(len(words)))
                around = contexts(words, first)
                for at in range(0, len(words), 4096):
                    sums[at + 1 : at + 4097] = forward(p, around[at : at + 4096], words[at : at + 4096])[0]
                total = np.cumsum(sums)[first]
                total, lengths = np.diff(total), np.diff(first)
                mean = pa.array(total / np.maximum(lengths, 1), mask=lengths == 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(lengths), pa.array(total), mean], ["doc_id", "n_words", "log_likelihood", "mean_log_probability"])

    return ids.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, log_likelihood double, mean_log_probability double")
