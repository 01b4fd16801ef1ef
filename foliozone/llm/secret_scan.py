"""Secret scans: fixed patterns, and character Markov models of random strings and of identifiers.

The base patterns find assigned values, access keys and long hex strings. Two first-order models
of characters, one of random strings and one of ordinary identifiers, are trained on samples that
the base patterns label: values they find are random strings, all other long tokens ordinary ones.
A token is added as kind ``random`` if the mean log-likelihood ratio of its character pairs, random
over ordinary, reaches ``LEAST_RATIO``, and it meets no base span.

Training reads the documents whose text hash falls under a threshold that makes their expected
number ``SAMPLE``; counts are sums over at most (alphabet + 1) squared pairs for either class, the
only thing that reaches the driver. Everything else covers all rows. The whole path is DataFrame
operations on single rows; nothing is exchanged but the sums.

Null and empty texts have no spans. Without any sample the models are equal and add nothing.
Repeated rows get equal results, one each. Spans are code points, end exclusive.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliozone.llm.native import indices, let, matches, no_nulls, running
from foliozone.llm.tables import wrapped

#: The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

SAMPLE = 5_000
#: Tokens that the models see, and the mean ratio (natural logarithm) from which one is a secret.
TOKEN, LEAST_RATIO = r"[A-Za-z0-9+/_=-]{20,}", 0.7
ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
_SIZE = len(ALPHABET) + 1  # and one for all other characters
#: The weight of the even distribution in each model, in pairs.
PRIOR = 200.0

_SPANS = "array<struct<first:int,kind:int,end:int,found:string>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _of(text: Column, regex: str, kind: int) -> Column:
    gate = F.regexp_like(text, F.lit(regex))
    spans = F.transform(matches(text, regex), lambda m: F.struct(m["first"].alias("first"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["found"].alias("found")))
    return F.when(gate, spans).otherwise(_none())


def base_spans(text: Column) -> Column:
    """The spans of the three base patterns, by start and kind."""
    assigned = F.filter(_of(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6)
    return F.array_sort(F.concat(assigned, _of(text, ACCESS, 1), _of(text, HEX, 2)))


def _pairs(token: Column) -> Column:
    """The number of each pair of neighbouring characters."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return let(codes, lambda n: F.transform(indices(F.size(n) - 1), lambda i: F.get(n, i) * _SIZE + F.get(n, i + 1)))


def _outside(tokens: Column, base: Column) -> Column:
    """The tokens (kind 3) that meet no base span: none before reaches in, none starts before the end."""
    far = F.lit(2**31 - 1)

    def apart(spans: Column) -> Column:
        reached = running(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), F.greatest)
        ahead = F.reverse(running(F.reverse(F.transform(spans, lambda s: F.when(s["kind"] < 3, s["first"]).otherwise(far))), F.least))
        both = F.struct(reached.alias("reached"), ahead.alias("ahead"))
        return let(both, lambda b: F.filter(spans, lambda s, i: (s["kind"] == 3) & (F.get(b["reached"], i) <= s["first"]) & (F.get(b["ahead"], i) >= s["end"])))

    return F.when(F.size(tokens) == 0, _none()).otherwise(let(F.array_sort(F.concat(base, tokens)), apart))


def train(docs: DataFrame, sample: int = SAMPLE) -> list[float]:
    """The log-likelihood ratio of every pair of characters, random over ordinary."""
    share = min(1.0, sample / max(1, docs.count()))
    text = no_nulls()
    chosen = docs.filter(F.pmod(F.xxhash64(text), F.lit(1_000_000)) < round(share * 1_000_000)).select(text.alias("t"))
    spans = chosen.select("t", base_spans(F.col("t")).alias("b"), _of(F.col("t"), r"[A-Za-z0-9+/_=-]{12,}", 3).alias("k"))
    value = lambda s: F.when(s["kind"] == 0, F.regexp_extract(s["found"], ASSIGN, 2)).otherwise(s["found"])
    ordinary = _outside(F.col("k"), F.col("b"))
    label = lambda kind: lambda t: F.struct(F.lit(kind).alias("random"), t.alias("token"))
    tokens = spans.select(F.explode(F.concat(F.transform(F.transform("b", value), label(1)), F.transform(F.transform(ordinary, lambda k: k["found"]), label(0)))).alias("x"))
    counts = tokens.select("x.random", F.explode(_pairs(F.col("x.token"))).alias("pair")).groupBy("random", "pair").count()
    models = [[PRIOR / _SIZE**2] * _SIZE**2 for _ in range(2)]
    for random, pair, n in counts.collect():
        models[random][pair] += n
    odds = []
    for cells in models:
        logs = []
        for first in range(_SIZE):
            row = cells[first * _SIZE : (first + 1) * _SIZE]
            logs += [math.log(c / sum(row)) for c in row]
        odds.append(logs)
    return [round(r - o, 4) for o, r in zip(*odds, strict=True)]


def scan(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """doc (the whole row), doc_id, text, base and spans, the last two arrays of (first, kind, end, found)."""
    ratios = train(docs) if ratios is None else ratios
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    text = no_nulls()

    def likely(token: Column) -> Column:
        total = F.aggregate(_pairs(token), F.lit(0.0), lambda acc, p: acc + F.get(table, p))
        return total / (F.length(token) - 1) >= LEAST_RATIO

    base = base_spans(text)
    tokens = _of(text, TOKEN, 3)
    both = F.struct(base.alias("base"), tokens.alias("tokens"))
    added = let(both, lambda s: F.struct(s["base"].alias("base"), F.array_sort(F.concat(s["base"], F.filter(_outside(s["tokens"], s["base"]), lambda k: likely(k["found"])))).alias("spans")))
    return wrapped(docs).select("doc", "doc_id", "text", added.alias("found")).select("doc", "doc_id", "text", "found.*")


def described(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["first"].cast("string"), s["end"].cast("string"))), ",")


def digest(result: DataFrame) -> DataFrame:
    """The columns of the query."""
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")
    return result.select("doc_id", number(0), number(1), number(2), F.sha2(described("base").cast("binary"), 256).alias("base_sha256"), described("spans").alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or spans that meet, replaced by ``mark``.

    Not to be selected under the name of the text column beside other uses of it: inside lambdas
    Spark would take the new column for the old.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(acc: Column, s: Column) -> Column:
        before = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["first"] - acc["at"]), F.lit(mark))
        return F.struct(F.when(s["first"] >= acc["at"], before).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    return F.aggregate(spans, start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
