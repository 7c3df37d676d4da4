"""Ordered substring classification (J2) and the flow map source.

"First pattern (in map order) contained in the value, else a default" is a
theta join.  A map whose size is checked to be that of a configuration document
(``RULES`` patterns, ``RULE_CHARS`` characters) is a chain of conditions on
each row, inside the scan's generated code, without a join or a shuffle.  A
larger map is joined, with the same results:

* every pattern is filed under one of its three-character grams, the one that
  the fewest patterns contain (a shorter pattern under itself);
* the distinct values are exploded into their grams, keeping only grams that
  a pattern may be filed under (a bitmap of fixed size, ``GRAM_BITS``);
* grams are equi-joined to the patterns, ``contains`` decides, the pattern of
  least ``(ord, pattern)`` wins per value (``min_by``, combined map-side), and
  the flows are joined back to the rows on the value.

Nothing of a larger map is broadcast by hand or collected; an empty pattern
matches every value that is not null, a matching pattern with a null flow gives
null, and equal ``ord`` go by pattern text.  A null value gets the default and
a null pattern matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger import schemas

# Fixed value: the flow name when no pattern matches.
UNKNOWN_FLOW = "unknown-pipeline"
RULES = 64
RULE_CHARS = 1 << 14
GRAM = 3
GRAM_BITS = 1 << 16


def read_flow_map(spark: SparkSession, path: str) -> DataFrame:
    """``{"flow_patterns": {pattern: flow, ...}}`` -> ord, pattern, flow.

    Map order is the file order; ``ord`` makes it explicit.
    """
    doc = spark.read.option("multiLine", "true") \
        .schema(schemas.FLOW_MAP_DOC).json(path)
    return doc.select(F.posexplode("flow_patterns")
                      .alias("ord", "pattern", "flow"))


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of ``size`` characters (none if too short)."""
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        starts, lambda i: F.substring(text, i, F.lit(size))))
    ).otherwise(F.array().cast("array<string>"))


def _filed(flow_map: DataFrame) -> DataFrame:
    """The non-empty patterns with the gram each is filed under."""
    p = flow_map.where(F.length("pattern") > 0).select("ord", "pattern",
                                                       "flow")
    text = F.col("pattern")
    grams = F.when(F.length(text) < GRAM, F.array(text)).otherwise(
        _grams(text, GRAM))
    each = p.select("pattern", F.explode(grams).alias("gram")).distinct()
    common = each.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    best = (each.join(common, "gram").groupBy("pattern")
            .agg(F.min(F.struct("n", "gram")).alias("g"))
            .select("pattern", F.col("g.gram").alias("gram")))
    return p.join(best, "pattern")


def _gram_bit(gram: Column) -> Column:
    return F.xxhash64(gram).bitwiseAND(F.lit(GRAM_BITS - 1))


def _gram_bits(filed: DataFrame) -> list[int]:
    """The bitmap of the grams in use, as GRAM_BITS / 32 numbers."""
    rows = (filed.select(_gram_bit(F.col("gram")).alias("bit"))
            .select(F.shiftright("bit", 5).alias("at"),
                    F.expr("shiftleft(1L, int(bit & 31))").alias("m"))
            .groupBy("at").agg(F.bit_or("m").alias("m")).collect())
    out = [0] * (GRAM_BITS // 32)
    for r in rows:
        out[r["at"]] = r["m"]
    return out


def _rules(flow_map: DataFrame) -> list[tuple[str, str | None]] | None:
    """(pattern, flow) in order of precedence; null for a larger map."""
    rows = flow_map.where("pattern is not null").select(
        "ord", F.left("pattern", F.lit(RULE_CHARS + 1)).alias("pattern"),
        "flow").limit(RULES + 1).collect()
    if len(rows) > RULES or sum(len(r["pattern"]) for r in rows) > RULE_CHARS:
        return None
    rows.sort(key=lambda r: (r["ord"] is not None, r["ord"] or 0,
                             r["pattern"].encode()))
    return [(r["pattern"], r["flow"]) for r in rows]


def classify_flow(df: DataFrame, value_col: str, flow_map: DataFrame,
                  out_col: str = "flow",
                  default: str = UNKNOWN_FLOW) -> DataFrame:
    """Add ``out_col``: the flow of the first matching pattern.

    ``df`` is a batch DataFrame; a stream classifies its micro-batches.
    """
    rules = _rules(flow_map)
    if rules is None:
        return _joined_flow(df, value_col, flow_map, out_col, default)
    flow = F.when(df[value_col].isNull(), F.lit(default))
    for pattern, name in rules:
        flow = flow.when(df[value_col].contains(F.lit(pattern)),
                         F.lit(name).cast("string"))
    return df.withColumn(out_col, flow.otherwise(F.lit(default)))


def _joined_flow(df: DataFrame, value_col: str, flow_map: DataFrame,
                 out_col: str, default: str) -> DataFrame:
    """The flow by an equi-join of grams."""
    filed = _filed(flow_map)
    bits = F.lit(_gram_bits(filed))
    values = df.select(F.col(value_col).alias("_v")).where(
        "_v is not null").distinct()
    every = F.flatten(F.array(*[_grams(F.col("_v"), n)
                                for n in range(1, GRAM + 1)]))

    def in_use(g: Column) -> Column:
        bit = _gram_bit(g)
        word = F.get(bits, F.shiftright(bit, 5).cast("int"))
        at = bit.bitwiseAND(F.lit(31)).cast("int")
        return F.call_function("shiftright", word, at).bitwiseAND(
            F.lit(1)) == 1

    hits = (values.select("_v", F.explode(F.filter(every, in_use))
                          .alias("gram"))
            .join(filed, "gram").where(F.col("_v").contains(F.col("pattern")))
            .select("_v", "ord", "pattern", "flow"))
    empty = flow_map.where(F.length("pattern") == 0).select(
        "ord", "pattern", "flow").limit(1)
    anything = empty.collect()   # the empty pattern, if the map has it
    if anything:
        hits = hits.unionByName(values.select(
            "_v", F.lit(anything[0]["ord"]).alias("ord"),
            F.lit("").alias("pattern"),
            F.lit(anything[0]["flow"]).cast("string").alias("flow")))
    first = hits.groupBy("_v").agg(F.min_by(
        F.struct("flow"), F.struct("ord", "pattern")).alias("_hit"))
    return (df.join(first, df[value_col] == first["_v"], "left")
            .withColumn(out_col, F.when(F.col("_hit").isNull(),
                                        F.lit(default))
                        .otherwise(F.col("_hit.flow")))
            .drop("_v", "_hit"))
