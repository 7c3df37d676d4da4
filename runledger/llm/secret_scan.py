"""Operator 1: secret scan with a randomness test battery.

Three base patterns (assignments, access keys, hexadecimal runs) are located
in every whole text.  Besides, every run of 20 or more encoding characters
that holds a digit and a letter is tested for randomness under its inferred
encoding; a run that mixes the signs of several encodings is cut at ``/``,
``_`` and ``-``, and ``=`` belongs to a run as its padding only:

* chi-squared uniformity of its characters over the encoding's alphabet;
* a runs test on the character classes (lower, upper, digit, other);
* the lag-1 serial correlation of the character codes.

Each test measures how implausible the token is as ordinary text, an
identifier or a sequence: its null hypothesis is the least random value that
such text reaches (the ``NULL_*`` parameters).  A token counts as random only
if all three nulls are implausible, so its p-value is the largest of three
(an intersection-union test, valid under any dependence).  Short tokens have
little power, hence the p-values are cut per length band by the
Benjamini-Hochberg rule over all tokens of the corpus.  The rule works on a
histogram of p-values, whose size is fixed (bands x bins).

Positions are code points, end exclusive.  Defined results: a null or empty
text has no spans; repeated rows are scanned one by one; null ids are kept;
an empty table gives an empty result.  Added spans never overlap base ones.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.common import doc_texts, stored

# The base patterns and the order of the kinds.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*"
          r"[\"']?([A-Za-z0-9+/_.=-]+)")
# A greedy run that is too short holds no longer match, so the least length
# may stand in the pattern for these two (it may not for assignments).
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# A whole run of one encoding with its padding, or of a run that mixes '/'
# with '_' or '-' each part between these.  '=' otherwise ends a run.
CANDIDATE = (r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/]{20,}+|[A-Za-z0-9_-]{20,}+)"
             r"(?![A-Za-z0-9+/_-])={0,2}|[A-Za-z0-9+]{20,}+={0,2}")
KINDS = ("assign", "access", "hex", "random")
ASSIGN_VALUE_LENGTH = 8
BLOCK = 64

# Inferred encodings, tried in this order, with alphabet size.
ENCODINGS = (("^[0-9a-f]+$", 16), ("^[0-9A-F]+$", 16), ("^[A-Z2-7]+$", 32),
             ("^[A-Za-z0-9]+$", 62), ("^[A-Za-z0-9+/]+$", 64),
             ("^[A-Za-z0-9_-]+$", 64))

NULL_REPEAT = {16: 0.11, 32: 0.07, 62: 0.066, 64: 0.066}  # sum of squares
NULL_REPEAT_SPREAD = 0.0011    # sum of cubes less the square of the above
NULL_SWITCH = 0.25             # chance of a change of character class
NULL_SERIAL = 0.5              # serial correlation
FALSE_DISCOVERY = 0.05
BINS = 300                     # tenths of -log10 p


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.transform(F.array(value), body)[0]


def _blocks(items: Column) -> Column:
    """An array cut into blocks of its length's cube root, 64 at least, so
    that nothing is done for every pair of items."""
    return _let(items, lambda a: _let(
        F.greatest(F.lit(BLOCK), F.ceil(F.cbrt(F.size(a))).cast("int")),
        lambda n: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0)), n),
            lambda i: F.slice(a, i + 1, n))))


def _placed(steps: Column, at: Column) -> Column:
    """(start, end) of the matches of a block whose text begins at ``at``."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(
        steps, F.struct(at.alias("at"), empty.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["len"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"),
                (acc["at"] + s["gap"] + s["len"]).alias("end")))
            ).alias("out")),
        lambda acc: acc["out"])


def _block_starts(blocks: Column) -> Column:
    """Where the text of each block begins: running sums of their widths."""
    empty = F.array().cast("array<int>")
    return F.aggregate(
        blocks, F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, b: F.struct(
            F.aggregate(b, acc["at"], lambda n, s: n + s["gap"] + s["len"])
            .alias("at"),
            F.concat(acc["out"], F.array(acc["at"])).alias("out")),
        lambda acc: acc["out"])


def _located(text: Column, pattern: str, group: int | None = None) -> Column:
    """Array of (start, end, value) of all leftmost matches of a pattern."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    value = found if group is None else F.regexp_extract_all(
        text, p, F.lit(group))
    between = F.transform(F.split(text, pattern, -1), F.length)
    widths = F.transform(found, F.length)
    # Pieces and matches alternate: piece i ends where match i starts.
    steps = F.zip_with(F.slice(between, 1, F.size(found)), widths,
                       lambda a, b: F.struct(a.alias("gap"), b.alias("len")))
    spans = _let(_blocks(steps), lambda blocks: F.flatten(F.zip_with(
        blocks, _block_starts(blocks), _placed)))
    out = F.zip_with(spans, value, lambda s, v: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), out).otherwise(none)


def _bounded(spans: Column) -> Column:
    """Blocks of spans with the range that each covers."""
    return F.transform(_blocks(spans), lambda b: F.struct(
        F.array_min(F.transform(b, lambda s: s["start"])).alias("start"),
        F.array_max(F.transform(b, lambda s: s["end"])).alias("end"),
        b.alias("of")))


def _apart(candidates: Column, spans: Column) -> Column:
    """The candidates that overlap none of the spans, found by two levels of
    blocks above these."""

    def meets(c: Column, s: Column) -> Column:
        return F.coalesce((s["start"] < c["end"]) & (s["end"] > c["start"]),
                          F.lit(False))

    return _let(_bounded(_bounded(spans)), lambda top: F.filter(
        candidates, lambda c: ~F.exists(top, lambda t: meets(c, t) & F.exists(
            t["of"], lambda b: meets(c, b) & F.exists(
                b["of"], lambda s: meets(c, s))))))


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"]),
        F.lit(":"), s["start"].cast("string"), F.lit(":"),
        s["end"].cast("string"))), ",")


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"),
        F.lit(KINDS.index(kind) + 1).alias("kind"), m["end"].alias("end")))


def base_scan(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, n_assign, n_access, n_hex, base (spans) and the
    candidate tokens that overlap no base span."""
    t = F.col("text")
    rows = doc_texts(docs).select(
        F.monotonically_increasing_id().alias("row_no"), "doc_id",
        F.filter(_located(t, ASSIGN, 2), lambda m: F.length(m["value"])
                 >= ASSIGN_VALUE_LENGTH).alias("assign"),
        _located(t, ACCESS).alias("access"), _located(t, HEX).alias("hex"),
        F.filter(_located(t, CANDIDATE), lambda m: m["value"].rlike("[0-9]")
                 & m["value"].rlike("[A-Za-z]")).alias("candidates"))
    rows = rows.withColumn("base", F.concat(*[
        _tagged(F.col(k), k) for k in KINDS[:3]]))
    return rows.select(
        "row_no", "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], "base",
        _apart(F.col("candidates"), F.col("base")).alias("candidates"))


def _lower_tail(z: Column) -> Column:
    """Normal lower-tail probability (the usual fifth-degree formula)."""
    x = F.abs(z)
    t = 1 / (1 + x * 0.2316419)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (
        1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z <= 0, tail).otherwise(1 - tail)


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds alphabet size ``k``, length ``n`` and ``p_value`` to tokens
    (column ``value``); tokens of no known encoding are left out."""
    body = F.regexp_replace("value", "=+$", "")
    k = F.lit(None).cast("int")
    for pattern, size in reversed(ENCODINGS):
        k = F.when(F.col("body").rlike(pattern), size).otherwise(k)
    rows = (tokens.withColumn("body", body).withColumn("k", k)
            .filter("k is not null and length(body) >= 20")
            .withColumn("n", F.length("body").cast("double"))
            .withColumn("codes", F.transform(F.split("body", ""), F.ascii)))
    rows = rows.withColumn("codes", F.filter("codes", lambda c: c > 0))
    squares = F.aggregate(
        F.transform(F.array_distinct("codes"), lambda c: F.size(
            F.filter("codes", lambda x: x == c)).cast("double")),
        F.lit(0.0), lambda acc, c: acc + c * c)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.regexp_replace("body", "[a-z]+", "a"), "[A-Z]+", "B"),
        "[0-9]+", "0"), "[+/_-]+", "-")
    i = F.sequence(F.lit(1), F.size("codes") - 1)

    def total(f):
        return F.aggregate(i, F.lit(0.0), lambda acc, j: acc + f(j))

    def code(j):
        return F.element_at("codes", j).cast("double")

    rows = rows.select(
        *tokens.columns, "k", "n", squares.alias("sq"),
        (F.length(classes) - 1).cast("double").alias("switches"),
        total(lambda j: code(j)).alias("sx"),
        total(lambda j: code(j + 1)).alias("sy"),
        total(lambda j: code(j) * code(j)).alias("sxx"),
        total(lambda j: code(j + 1) * code(j + 1)).alias("syy"),
        total(lambda j: code(j) * code(j + 1)).alias("sxy"))
    n, m = F.col("n"), F.col("n") - 1
    kappa = F.lit(None).cast("double")
    for size, value in NULL_REPEAT.items():
        kappa = F.when(F.col("k") == size, value).otherwise(kappa)
    # The chi-squared statistic is k/n * sum of squares - n: test the sum.
    chi = (F.col("sq") - (n + n * m * kappa)) / F.sqrt(
        2 * n * n * kappa + 4 * n * n * n * NULL_REPEAT_SPREAD)
    runs = (m * NULL_SWITCH - F.col("switches")) / F.sqrt(
        m * NULL_SWITCH * (1 - NULL_SWITCH))
    spread = ((F.col("sxx") - F.col("sx") * F.col("sx") / m)
              * (F.col("syy") - F.col("sy") * F.col("sy") / m))
    r = F.when(spread > 0, (F.col("sxy") - F.col("sx") * F.col("sy") / m)
               / F.sqrt(spread)).otherwise(1.0)
    r = F.least(F.greatest(r, F.lit(-0.999999)), F.lit(0.999999))
    serial = (F.atanh(r) - F.atanh(F.lit(NULL_SERIAL))) * F.sqrt(m - 3)
    return (rows.withColumn("z_uniform", chi).withColumn("z_runs", runs)
            .withColumn("z_serial", serial)
            .withColumn("p_value", F.greatest(
                _lower_tail(F.col("z_uniform")), _lower_tail(F.col("z_runs")),
                _lower_tail(F.col("z_serial"))))
            .drop("sq", "switches", "sx", "sy", "sxx", "syy", "sxy"))


def discoveries(tested: DataFrame, q: float = FALSE_DISCOVERY) -> DataFrame:
    """Benjamini-Hochberg per length band (factors of root two)."""
    rows = tested.withColumn("band", F.floor(F.log2("n") * 2).cast("int")) \
        .withColumn("bin", F.least(F.lit(BINS), F.floor(
            -10 * F.log10(F.greatest("p_value", F.lit(1e-30))))).cast("int"))
    hist = rows.groupBy("band", "bin").count()
    band = Window.partitionBy("band")
    hist = (hist.withColumn("tests", F.sum("count").over(band))
            .withColumn("rank", F.sum("count").over(
                band.orderBy(F.desc("bin")))))
    # Bin b holds p-values up to 10 ** (-b / 10).
    cut = (hist.filter(F.pow(F.lit(10.0), -F.col("bin") / 10)
                       * F.col("tests") <= q * F.col("rank"))
           .groupBy("band").agg(F.min("bin").alias("cut")))
    # At most one row for each half power of two of a token's length.
    return rows.join(F.broadcast(cut), "band").filter("bin >= cut") \
        .drop("bin", "cut")


def scan(docs: DataFrame, q: float = FALSE_DISCOVERY) -> DataFrame:
    """One row per document with all its spans; see the module text."""
    base = stored(base_scan(docs), "secret-scan")
    tokens = base.filter(F.size("candidates") > 0).select(
        "row_no", F.explode("candidates").alias("c")).select("row_no", "c.*")
    added = discoveries(randomness(tokens), q).groupBy("row_no").agg(
        F.collect_list(F.struct(
            "start", F.lit(len(KINDS)).alias("kind"), "end")).alias("added"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return base.join(added, "row_no", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_random"),
        F.sha2(_spans_text(F.col("base")).cast("binary"), 256)
        .alias("base_sha256"),
        _spans_text(F.concat("base", F.coalesce("added", none)))
        .alias("spans"))
