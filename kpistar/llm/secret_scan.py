"""Secret scans: fixed patterns plus character Markov models, in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of three patterns (matches that
fail their length test are consumed, then dropped).  Positions come from splitting the
text at the matches: a match starts after the lengths of all pieces and matches before
it.  Further spans are runs of ``candidate`` characters that a first-order Markov model
of random strings explains better than one of ordinary identifiers, by at least
``margin`` nats; runs that overlap a base span add nothing.

The two models are add-one smoothed counts of character pairs of labelled samples
(text, label 1 random / 0 ordinary).  ``labelled_samples`` takes them from at most about
``sample_rows`` documents, chosen by hash: strings that the base patterns found are
random, long words of letters are ordinary.  The models are one table of 128 x 128
ratios, whatever the input.

Positions count code points, ends are exclusive.  A null text is empty and has no span;
without samples both models are uniform and nothing is added; rows with equal or null
doc_id are scanned one by one.  Columns of the input may have any names (``spans`` adds a
column of that name, in place of one that the input has).  Positions, overlaps and masks
are running values over arrays, taken in blocks of ``BLOCK`` elements: an array that is
appended to stays short, so a text of many matches takes time in proportion to them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpistar.llm.shared import documents

# The base patterns, the kinds in the order in which spans of equal start are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"          # of AKIA[A-Z0-9]+ those of 20 characters and more
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"    # of [0-9a-f]+ those of 24 characters and more
KINDS = ("assign", "access", "hex", "markov")
SPAN = "struct<start:int,kind:int,end:int,ok:boolean>"
BLOCK = 256


@dataclass(frozen=True)
class Params:
    candidate: str = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
    ordinary: str = r"(?<![A-Za-z0-9_])[A-Za-z_]{8,}(?![A-Za-z0-9_])"
    margin: float = 10.0
    sample_rows: int = 5000
    mask: str = "[SECRET]"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _blocks(array: str) -> str:
    return f"sequence(0, cast((size({array}) - 1) div {BLOCK} as int))"


def _running(array: str, zero: str, value: str, merge: str, emit: str, kind: str) -> str:
    """SQL array of ``emit`` (of type ``kind``) for each x of ``array``, where s.pos is the merge of the values before x.

    ``merge`` joins two values {0} and {1}.  Blocks are merged first, then each starts from the blocks before it.
    """
    block = f"slice(a, {BLOCK} * b + 1, {BLOCK})"
    return f"""transform(array({array}), a -> transform(array(
        aggregate(transform({_blocks('a')}, b -> aggregate({block}, {zero}, (s, x) -> {merge.format('s', value)})),
                  array({zero}), (o, t) -> concat(o, array({merge.format('element_at(o, -1)', 't')})))),
        o -> flatten(transform({_blocks('a')}, b -> aggregate({block},
            struct(o[b] as pos, cast(array() as array<{kind}>) as out),
            (s, x) -> struct({merge.format('s.pos', value)} as pos, concat(s.out, array({emit})) as out),
            s -> s.out))))[0])[0]"""


def _found(pattern: str, kind: str, passes: str = "true") -> Column:
    """array<SPAN> of the matches x that pass a test."""
    q = _quoted(pattern)
    matches = f"""transform(array(regexp_extract_all(_text, {q}, 0)), m -> zip_with(
        slice(split(_text, {q}, -1), 1, size(m)), m, (p, x) -> struct(length(p) as gap, length(x) as len, {passes} as ok)))[0]"""
    emit = f"struct(s.pos + x.gap as start, {KINDS.index(kind)} as kind, s.pos + x.gap + x.len as end, x.ok as ok)"
    return F.expr(f"""if(_text rlike {q}, filter({_running(matches, '0', 'x.gap + x.len', '{0} + {1}', emit, SPAN)}, x -> x.ok),
                         cast(array() as array<{SPAN}>))""")


def _apart(near: str, base: str) -> Column:
    """The spans of ``near`` that overlap none of ``base``: by start, no end before lies beyond theirs, and no start after within."""
    least, emit = "2147483647", "struct(x.start as start, x.kind as kind, x.end as end, x.ok and {} as ok)"
    before = _running(f"array_sort(concat({base}, {near}))", "0", "if(x.kind < 3, x.end, 0)", "greatest({0}, {1})", emit.format("s.pos <= x.start"), SPAN)
    after = _running(f"reverse({before})", least, f"if(x.kind < 3, x.start, {least})", "least({0}, {1})", emit.format("s.pos >= x.end"), SPAN)
    return F.expr(f"if(size({near}) = 0 or size({base}) = 0, {near}, filter({after}, x -> x.ok and x.kind = 3))")


def labelled_samples(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(sample, label) strings from about ``sample_rows`` documents, all of a smaller input."""
    total = docs.count()
    some = docs.select(F.coalesce("text", F.lit("")).alias("t"))
    if total > p.sample_rows:
        some = some.where(F.pmod(F.xxhash64("t"), F.lit(total)) < p.sample_rows)
    random = F.flatten(F.array(F.expr(f"regexp_extract_all(t, {_quoted(ASSIGN)}, 2)"), *[
        F.expr(f"regexp_extract_all(t, {_quoted(x)}, 0)") for x in (ACCESS, HEX)]))
    return some.select(F.explode(random).alias("sample"), F.lit(1).alias("label")).where("length(sample) >= 6").unionByName(
        some.select(F.explode(F.expr(f"regexp_extract_all(t, {_quoted(p.ordinary)}, 0)")).alias("sample"), F.lit(0).alias("label")))


def log_ratios(samples: DataFrame) -> np.ndarray:
    """log P(b after a | random) - log P(b after a | ordinary) at 128 * a + b."""
    pair = "transform(sequence(2, size(c)), i -> 128 * ascii(c[i - 2]) + ascii(c[i - 1]))"
    counted = (samples.where("length(sample) > 1 and sample rlike r'^[!-~]+$'").select("label", F.expr("split(sample, '')").alias("c"))
               .select("label", F.explode(F.expr(pair)).alias("pair")).groupBy("label", "pair").count().collect())
    counts = np.ones((2, 128, 128))
    for label, pair_code, n in counted:
        counts[label, pair_code // 128, pair_code % 128] += n
    logs = np.log(counts / counts.sum(2, keepdims=True))
    return (logs[1] - logs[0]).ravel()


def _located(docs: DataFrame, ratios: np.ndarray, p: Params) -> DataFrame:
    """row (a struct of all columns of ``docs``), _text and spans of every row."""
    table = f"cast(split('{','.join(f'{x:.5f}' for x in ratios)}', ',') as array<double>)"
    score = f"""transform(array(split(x, '')), c -> aggregate(
        zip_with(c, slice(c, 2, length(x)), (y, z) -> if(z is null, 0, 128 * ascii(y) + ascii(z) + 1)),
        0D, (r, i) -> r + if(i = 0, 0D, element_at({table}, i))))[0]"""
    out = docs.select(F.struct("*").alias("row")).withColumn("_text", F.coalesce("row.text", F.lit("")))
    for kind, pattern, passes in (("assign", ASSIGN, f"length(regexp_extract(x, {_quoted(ASSIGN)}, 2)) >= 6"), ("access", ACCESS, "true"), ("hex", HEX, "true")):
        out = out.withColumn(f"_{kind}", _found(pattern, kind, passes))
    out = out.withColumn("_base", F.concat("_assign", "_access", "_hex")).withColumn("_near", _found(p.candidate, "markov", f"{score} >= {p.margin}"))
    return out.withColumn("_added", _apart("_near", "_base")).select("row", "_text", F.expr(
        "transform(array_sort(concat(_base, _added)), x -> struct(x.start as start, x.kind as kind, x.end as end))").alias("spans"))


def spans(docs: DataFrame, ratios: np.ndarray, p: Params = Params()) -> DataFrame:
    """``docs`` with the added column spans: array<struct<start,kind,end>>, sorted."""
    return _located(docs.drop("spans"), ratios, p).select("row.*", "spans")


def listed(column: Column | str, kinds: tuple[str, ...] = KINDS) -> Column:
    """Spans of those kinds as kind:start:end, comma-joined."""
    names = "array('" + "','".join(KINDS) + "')"
    return F.array_join(F.transform(F.filter(column, lambda x: x["kind"].isin([KINDS.index(k) for k in kinds])), lambda x: F.concat(
        F.element_at(F.expr(names), x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def _masked() -> Column:
    """_text with each maximal stretch of overlapping spans replaced by _mask."""
    kept = f"""filter({_running('spans', '0', 'x.end', 'greatest({0}, {1})', 'struct(s.pos as lo, x.start as hi)', 'struct<lo:int,hi:int>')}, x -> x.hi >= x.lo)"""
    block = f"""transform(array(slice(k, {BLOCK} * b + 1, {BLOCK})), g -> transform(
        array(substring(_text, g[0].lo + 1, element_at(g, -1).hi - g[0].lo)),
        t -> array_join(transform(g, x -> concat(substring(t, x.lo - g[0].lo + 1, x.hi - x.lo), _mask)), ''))[0])[0]"""
    return F.expr(f"""if(size(spans) > 0, concat(
        transform(array({kept}), k -> array_join(transform({_blocks('k')}, b -> {block}), ''))[0],
        substring(_text, array_max(transform(spans, x -> x.end)) + 1, length(_text))), row.text)""")


def without_secrets(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` with every span of ``text`` masked and ``n_chars``, where there is one, counted anew."""
    out = _located(docs, log_ratios(labelled_samples(docs, p)), p).withColumn("_mask", F.lit(p.mask)).withColumn("_masked", _masked())
    new = {"text": F.col("_masked")}
    if "n_chars" in docs.columns:
        counted = F.length("_masked").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.size("spans") > 0, counted).otherwise(F.col("row.n_chars"))
    return out.select([new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = spans(docs, log_ratios(labelled_samples(docs)))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == KINDS.index(k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(listed("spans", KINDS[:3]), 256).alias("base_sha256"), listed("spans").alias("spans"))
