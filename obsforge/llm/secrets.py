"""Secret scanning: fixed patterns, and a battery of randomness tests on encoded-looking tokens. DataFrame functions only.

A token whose alphabet can be inferred (hexadecimal, base32, base64) is tested for being uniformly random: chi-squared of its
symbol counts, runs above and below the middle of the alphabet, and serial correlation. Three times the least of the three
p-values is its p-value. Structured tokens (paths, names, counters) are dismissed by the weighted Benjamini-Hochberg rule over
all tokens of the corpus: with weights in proportion to a token's information (symbols times bits), long tokens, on which the
tests have power, are dismissed more readily than short ones, and at most a share ALPHA of the dismissed are expected to be
random. What is not dismissed is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.common import identified
from obsforge.llm.spans import let, places
from obsforge.session import written

# Patterns of the fixed kinds. For hex and access, a match that is long enough is the whole run, so the length is in the pattern.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HEAD = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_LENGTH = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]  # order among spans that start at one place

TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"
MIN_BITS = 96  # tokens with less information are too short for the tests
ALPHA = 0.05
_HEX, _BASE32 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Grid of -log10(p / weight) on which the rule's threshold is searched.
_STEPS, _DEEPEST = 64, 40

_SPAN = "array<struct<kind:int,start:bigint,end:bigint>>"


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (relative error below 0.3 % for z >= 0)."""
    up = F.abs(z)
    one = F.exp(-up * up / 2) / ((0.661 * up + 0.339 * F.sqrt(up * up + 5.51)) * math.sqrt(2 * math.pi))
    return F.when(z >= 0, one).otherwise(1 - one)


def battery(symbols: Column, alphabet: Column) -> Column:
    """p-value of the hypothesis that `symbols` is uniformly random text over `alphabet`."""
    n, size = F.length(symbols).cast("double"), F.length(alphabet).cast("double")
    values = F.transform(F.sequence(F.lit(1), F.length(symbols)), lambda i: (F.position(symbols.substr(i, F.lit(1)), alphabet) - 1).cast("double"))
    return let(values, lambda v: _p_value(symbols, v, n, size))


def _p_value(symbols: Column, values: Column, n: Column, size: Column) -> Column:
    letters = F.array_distinct(values)
    total = F.lit(0.0)
    squares = F.aggregate(letters, total, lambda s, x: s + F.pow(F.size(F.filter(values, lambda y: y == x)).cast("double"), F.lit(2.0)))
    chi = (size / n * squares - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)

    high = F.transform(values, lambda v: v >= size / 2)
    ups = F.size(F.filter(high, lambda h: h)).cast("double")
    turns = F.size(F.filter(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1), lambda a, b: a != b), lambda t: t)).cast("double") + 1
    both = 2 * ups * (n - ups)
    spread = both * (both - n) / (n * n * (n - 1))
    runs = F.when(spread > 0, F.abs(turns - both / n - 1) / F.sqrt(spread)).otherwise(F.lit(30.0))

    middle = (size - 1) / 2
    products = F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1), lambda a, b: (a - middle) * (b - middle))
    serial = F.abs(F.aggregate(products, total, lambda s, x: s + x)) / ((size * size - 1) / 12 * F.sqrt(n - 1))
    least = F.least(_tail(chi), 2 * _tail(runs), 2 * _tail(serial))
    return F.greatest(F.least(3 * least, F.lit(1.0)), F.lit(10.0 ** -_DEEPEST))


def _inferred(token: Column) -> tuple[Column, Column]:
    """Symbols and alphabet of a token's encoding; a null alphabet if none can be inferred."""
    core = F.regexp_replace(token, "=+$", "")
    digit, lower, upper = core.rlike("[0-9]"), core.rlike("[a-z]"), core.rlike("[A-Z]")
    hexadecimal = core.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & (lower | upper)
    base32 = core.rlike("^[A-Z2-7]+$") & digit & upper
    symbols = F.when(hexadecimal, F.lower(core)).when(base32, core).otherwise(F.translate(core, "-_", "+/"))
    alphabet = F.when(hexadecimal, F.lit(_HEX)).when(base32, F.lit(_BASE32)).when(digit & lower & upper, F.lit(_BASE64))
    return symbols, alphabet


def _kind(text: Column, gate: str, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Spans of one fixed kind; the costly search runs only where the gate pattern occurs."""
    found = F.filter(places(text, F.lit(pattern), group), lambda m: F.length(m["found"]) >= least)
    spans = F.transform(found, lambda m: F.struct(F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    return F.when(text.rlike(gate), spans).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def _candidates(text: Column, base: Column) -> Column:
    """Tokens with an inferred encoding and enough information that lie in no base span: (start, end, bits, p)."""
    shape = "array<struct<start:bigint,end:bigint,bits:double,p:double>>"

    def tested(m: Column) -> Column:
        symbols, alphabet = _inferred(m["found"])
        bits = F.length(symbols) * F.log2(F.length(alphabet))
        p = F.when(bits >= MIN_BITS, battery(symbols, alphabet))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), bits.alias("bits"), p.alias("p"))

    free = F.filter(places(text, F.lit(TOKEN)), lambda m: ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])))
    found = F.filter(F.transform(free, tested), lambda t: t["p"].isNotNull())
    return F.when(text.rlike(TOKEN), found).otherwise(F.array().cast(shape)).cast(shape)


def _named(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _grid(weighted: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(_DEEPEST * _STEPS), F.floor(-F.log10(weighted) * _STEPS))).cast("int")


def dismissal_threshold(tested: DataFrame, mean_bits: float, alpha: float = ALPHA) -> int:
    """Least grid step at which p / weight is dismissed: the Benjamini-Hochberg rule on counts per step; one beyond the grid if none.

    tested: one row per token (bits, p). At most _DEEPEST * _STEPS + 1 counts reach the driver.
    """
    counts = {r["step"]: r["n"] for r in tested.groupBy(_grid(F.col("p") * mean_bits / F.col("bits")).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, rejected, best = sum(counts.values()), 0, _DEEPEST * _STEPS + 1
    for step in sorted(counts, reverse=True):
        rejected += counts[step]
        if 10 ** (-step / _STEPS) <= alpha * rejected / total:
            best = step
    return best


def find_secrets(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row of `docs` (doc_id, text, any other columns).

    spans lists kind:start:end of all findings, fixed kinds and `random`, by start and kind; base_sha256 is the SHA-256 of the
    same list without `random`. Positions are code points, end exclusive. Null counts as empty text; rows that repeat give
    the same result each. An empty table gives no rows.
    """
    text = F.col("text")
    rows = identified(docs, "text").select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    kinds = [_kind(text, ASSIGN_HEAD, ASSIGN, "assign", 2, ASSIGN_LENGTH), _kind(text, ACCESS, ACCESS, "access"), _kind(text, HEX, HEX, "hex")]
    rows = rows.select("doc_id", "text", *[k.alias(n) for k, n in zip(kinds, KINDS)])
    rows = rows.select("doc_id", "text", *[F.size(n).cast("long").alias(f"n_{n}") for n in KINDS[:3]], F.concat(*KINDS[:3]).alias("base"))
    rows = written(rows.select("*", _candidates(text, F.col("base")).alias("tokens")).drop("text"), "secrets")

    tested = rows.select(F.explode("tokens").alias("t")).select("t.bits", "t.p")
    mean = tested.agg(F.avg("bits")).first()[0] or 1.0
    step = dismissal_threshold(tested, mean, alpha)
    kept = F.filter("tokens", lambda t: _grid(t["p"] * mean / t["bits"]) < step)
    extra = F.transform(kept, lambda t: F.struct(F.lit(KINDS.index("random")).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return rows.select(
        "doc_id", *[f"n_{n}" for n in KINDS[:3]], F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.concat("base", extra.cast(_SPAN))).alias("spans"),
    )
