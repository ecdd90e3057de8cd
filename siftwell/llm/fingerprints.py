"""Document fingerprints: homomorphic multiset hashes of paragraphs, with built-in functions only.

Every paragraph (line) hashes to a wide vector: six lanes modulo 2**40 from two
MD5 digests of the paragraph, the number of its sentences modulo 2**32, and 60
lanes modulo 2**31 that count the hash bits of its sentences (as_text gives them
modulo 2**16).  A fingerprint is
the sum of its paragraphs' vectors, each lane modulo its power of two.  So it
does not depend on the order of paragraphs, equal multisets of paragraphs have
equal fingerprints, and insertion or deletion of paragraphs is one addition or
subtraction (add, subtract) without the rest of the document.

The last 60 lanes are a linear sketch: with s = 2 * lane - sentences, read between
-2**31 and 2**31 as both are known modulo 2**32, the mean product of s and t over the lanes estimates the inner product of two texts'
sentence frequencies (the tug-of-war estimate).  likeness is 2 s.t / (s.s + t.t):
1 for equal multisets, about 0 for texts without a common sentence.  Sentences
are cut at . ! ? , ; | and the line's end.

OP8_SQL reads the lanes modulo 2**16, so its likeness holds only for texts of fewer
than 65,536 sentences.

Null texts count as empty.  Two texts without any sentence have likeness 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.ranges import borders, range_of

PARAGRAPH_LANES, PARAGRAPH_BITS = 6, 40
SKETCH_LANES, SKETCH_BITS, SKETCH_TEXT_BITS = 60, 31, 16
COUNT_BITS = 32
_SENTENCE_END = "[.!?,;|\n]+"
#: Rows of a range of ids that are sorted together to find each row's successor.
RANGE_ROWS = 512


def _number(digits: Column, begin, length: int) -> Column:
    return F.conv(F.substring(digits, begin, length), 16, 10).cast("bigint")


def _mask(value: Column, bits: int) -> Column:
    return value.bitwiseAND(F.lit((1 << bits) - 1))


def fingerprint(text: Column) -> Column:
    """struct(paragraphs array<bigint>, sentences bigint, sketch array<int>) of a text."""
    text = F.coalesce(text, F.lit(""))
    digests = F.transform(F.split(text, "\n"), lambda p: F.concat(F.md5(p.cast("binary")), F.md5(F.concat(F.lit("+"), p).cast("binary"))))
    zeros = F.array(*[F.lit(0).cast("bigint")] * PARAGRAPH_LANES)
    lanes = F.aggregate(digests, zeros, lambda acc, d: F.transform(acc, lambda a, k: _mask(a + _number(d, k * 10 + 1, 10), PARAGRAPH_BITS)))
    sentences = F.filter(F.split(text, _SENTENCE_END), lambda s: s != "")
    hashes = F.transform(sentences, lambda s: _number(F.md5(s.cast("binary")), F.lit(1), 15))
    start = F.struct(F.lit(0).cast("bigint").alias("sentences"), F.array(*[F.lit(0)] * SKETCH_LANES).alias("sketch"))
    sketch = F.aggregate(
        hashes,
        start,
        lambda acc, h: F.struct(
            _mask(acc["sentences"] + 1, COUNT_BITS).alias("sentences"),
            F.transform(acc["sketch"], lambda a, k: (a + F.getbit(h, k).cast("int")).bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))).alias("sketch"),
        ),
    )
    return F.struct(lanes.alias("paragraphs"), sketch.alias("counts"))


def _combined(a: Column, b: Column, sign: int) -> Column:
    def lane(bits: int):
        return lambda x, y: F.pmod(x + y * F.lit(sign), F.lit(1 << bits))

    return F.struct(
        F.zip_with(a["paragraphs"], b["paragraphs"], lane(PARAGRAPH_BITS)).alias("paragraphs"),
        F.struct(
            lane(COUNT_BITS)(a["counts"]["sentences"], b["counts"]["sentences"]).alias("sentences"),
            F.zip_with(a["counts"]["sketch"], b["counts"]["sketch"], lambda x, y: lane(SKETCH_BITS)(x.cast("bigint"), y).cast("int")).alias("sketch"),
        ).alias("counts"),
    )


def add(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    return _combined(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint of a's paragraphs without those of b."""
    return _combined(a, b, -1)


def as_text(fp: Column) -> Column:
    """The fingerprint in hexadecimal digits, lane by lane."""

    def digits(value: Column, bits: int) -> Column:
        return F.lpad(F.hex(value), bits // 4, "0")

    return F.concat(
        F.array_join(F.transform(fp["paragraphs"], lambda x: digits(x, PARAGRAPH_BITS)), ""),
        digits(fp["counts"]["sentences"], COUNT_BITS),
        F.array_join(F.transform(fp["counts"]["sketch"], lambda x: digits(_mask(x, SKETCH_TEXT_BITS), SKETCH_TEXT_BITS)), ""),
    )


def likeness(a: Column, b: Column) -> Column:
    """Between 0 and 1: the estimated share of sentences that two fingerprinted texts have in common."""
    n, m = a["counts"]["sentences"], b["counts"]["sentences"]

    def signed(fp: Column) -> Column:
        half = 1 << SKETCH_BITS
        return F.transform(fp["counts"]["sketch"], lambda x: (F.pmod(x.cast("bigint") * 2 - fp["counts"]["sentences"] + half, F.lit(2 * half)) - half).cast("double"))

    def product(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda acc, d: acc + d)

    squares = product(signed(a), signed(a)) + product(signed(b), signed(b))
    share = product(signed(a), signed(b)) * 2 / squares
    return F.when(n + m == 0, F.lit(1.0)).when(squares == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), share))


def with_next(df: DataFrame, id_col: str, payload: list[str], order_text: str, computed: dict[str, Column] | None = None) -> DataFrame:
    """df with a struct column next: the payload of the row that follows in descending id; the first one follows the last.

    computed: columns of the payload that are made of df's, once for each row.  Ids are cut into ranges of about
    RANGE_ROWS rows at quantiles (more, where RANGE_ROWS rows would make over MOST_RANGES ranges); each range is
    sorted by itself, which Spark does with spilling, and only the first rows of the ranges meet their neighbours.
    Rows with one id go by order_text, descending; null ids last.  Ids are numbers.
    """
    computed = computed or {}
    spark = df.sparkSession
    ids = df.select(F.col(id_col).alias("id"))
    splits = borders(df, id_col, df.count() // RANGE_ROWS + 1)
    # at most MOST_RANGES + 1 rows: the largest id of each range
    tops = ids.groupBy(range_of(F.col("id"), splits).alias("range")).agg(F.max("id").alias("id")).collect()
    present = sorted((r["range"] for r in tops), reverse=True)
    if not present:
        return df.withColumns(computed).withColumn("next", F.struct(*payload))
    follower = spark.createDataFrame(list(zip(present, [*present[1:], present[0]], strict=True)), "range int, head int")
    top_ids = spark.createDataFrame([(r["range"], r["id"]) for r in tops], f"head int, id {df.schema[id_col].dataType.simpleString()}")
    rows = df.withColumns(computed).withColumn("range", range_of(F.col(id_col), splits))
    plain = [c for c in payload if c not in computed]
    tops = df.join(F.broadcast(top_ids), df[id_col].eqNullSafe(top_ids["id"])).groupBy("head").agg(F.max_by(F.struct(*plain), F.struct(order_text)).alias("top"))
    top_rows = tops.select("head", "top.*").withColumns(computed).select("head", F.struct(*payload).alias("top"))
    heads = top_rows.join(F.broadcast(follower), "head").select("range", "top")
    within = F.expr(f"lead(struct({', '.join(payload)})) OVER (PARTITION BY range ORDER BY {id_col} DESC NULLS LAST, {order_text} DESC)")
    return rows.withColumn("within", within).join(heads.hint("merge"), "range", "left").withColumn("next", F.coalesce("within", "top")).drop("range", "within", "top")


def edited_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    The edited text has the last third of the characters (rounded down) replaced by as many, or all, of the next
    document's first ones.  Returns id, n_chars, edited, fp, edited_fp and next_fp.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    paired = with_next(rows, "id", ["text", "fp"], "text", {"fp": fingerprint(F.col("text"))}).select(
        "id",
        n.cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next.text", F.lit(1), cut)).alias("edited"),
        "fp",
        F.col("next.fp").alias("next_fp"),
    )
    return paired.withColumn("edited_fp", fingerprint(F.col("edited"))).withColumnRenamed("id", id_col)
