"""Mixing sources to target weights by Pareto order sampling.

A sample of n rows is divided among the sources by their targets, with largest remainders, so that it has
exactly n rows. Sources without any text can't give rows; their part goes to the others. Within a source a
document of weight w, the characters of its text, is expected in it n_s * w / W times (W: the weights of the
source). The whole part of that is certain: so many copies. The fraction p that is left is drawn with fixed
size: documents are ranked by their random odds u / (1 - u) over their inclusion odds p / (1 - p), and the
least are taken, just as many as bring the source to n_s.

u is a hash of doc_id and seed, so a sample can be repeated. Rows of one doc_id and length have the same rank;
where the sample ends among them, just as many are taken as are due, whichever. A null source is a source of
its own. Where doc_id is null, u is a hash of the text. Null and empty texts have weight 0 and are never taken. An
empty table gives an empty sample, as does one without any text. Other columns pass through ``mix``, whatever
they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut

SEED = "mix-1"
#: Sources whose figures are sent to all executors; with more of them rows are joined by source.
MOST_SOURCES = 100_000
#: Buckets into which ranks are counted to find where a source's sample ends.
BUCKETS = 65536
#: Parts in which rows of equal rank are numbered where a sample ends among them.
SALTS = 1024


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def _weight(long: int | None) -> Column:
    n = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0))
    return (n if long is None else F.least(n, F.lit(long))).cast("long")


def _u(seed: str) -> Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(seed))), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def _drawn(rows: DataFrame) -> DataFrame:
    """Adds the certain copies and the rank (null if nothing is left to draw)."""
    expected = F.col("n_s") * F.col("w") / F.col("of_w")
    p = F.col("e") - F.col("certain")
    q = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    rows = rows.withColumn("e", expected).withColumn("certain", F.floor("e").cast("long")).withColumn("q", F.when(p > 0, q)).drop("e")
    return rows.withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * BUCKETS).cast("int"))


def _sizes(narrow: DataFrame, targets: dict[str, float] | None, fraction: float) -> DataFrame:
    """(s, n_s, of_w): rows wanted and weight of each source."""
    by = narrow.groupBy("s").agg(F.sum("w").alias("of_w"), F.count("*").alias("n"))
    if targets is None:
        part = F.lit(1.0)
    else:
        part = F.coalesce(F.create_map(*[x for k, v in targets.items() for x in (F.lit("=" + k), F.lit(float(v)))])[F.col("s")], F.lit(0.0)) if targets else F.lit(0.0)
    every = Window.partitionBy()
    by = by.withColumn("part", F.when(F.col("of_w") > 0, part).otherwise(F.lit(0.0)))
    by = by.withColumn("size", F.floor(F.sum("n").over(every) * F.lit(float(fraction)) + 0.5)).withColumn("parts", F.sum("part").over(every))
    by = by.withColumn("due", F.when(F.col("parts") > 0, F.col("size") * F.col("part") / F.col("parts")).otherwise(F.lit(0.0))).withColumn("whole", F.floor("due"))
    at = F.row_number().over(Window.partitionBy().orderBy(F.desc(F.col("part") > 0), F.desc(F.col("due") - F.col("whole")), "s"))
    more = (F.col("part") > 0) & (at <= F.col("size") - F.sum("whole").over(every))
    return by.select("s", (F.col("whole") + more.cast("long")).cast("long").alias("n_s"), F.greatest("of_w", F.lit(1)).alias("of_w"))


def _with(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Rows with their source's figures. One source may hold most rows, so they aren't gathered by it."""
    few = by_source.count() <= MOST_SOURCES
    return rows.join(F.broadcast(by_source) if few else by_source, "s")


def _cuts(narrow: DataFrame, sizes: DataFrame) -> DataFrame:
    """(s, n_s, of_w, cut_q, cut_id, cut_rest, cut_n): the last rank that is taken in each source, how many rows of
    that rank are and how many there are; null if none is.

    Ranks are counted in buckets first, so that only one bucket of each source is sorted."""
    rows = _drawn(_with(narrow, sizes))
    counts = rows.groupBy("s", "bucket").agg(F.count("q").alias("k"), F.sum("certain").alias("c"), F.first("n_s").alias("n_s"))
    of = Window.partitionBy("s")
    counts = counts.withColumn("m", F.col("n_s") - F.sum("c").over(of)).withColumn("upto", F.sum("k").over(of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    edge = cut(counts.where("bucket is not null and upto >= m and upto - k < m").select("s", "bucket", (F.col("m") - F.col("upto") + F.col("k")).alias("rest")))
    order = Window.partitionBy("s").orderBy("q", "id")
    last = _with(rows, edge.withColumnRenamed("bucket", "edge")).where("bucket = edge").withColumn("at", F.row_number().over(order)).withColumn("first", F.rank().over(order))
    last = last.withColumn("same", F.count("*").over(Window.partitionBy("s", "q", "id"))).where("at = rest")
    return sizes.join(last.select("s", F.col("q").alias("cut_q"), F.col("id").alias("cut_id"), (F.col("at") - F.col("first") + 1).alias("cut_rest"), F.col("same").alias("cut_n")), "s", "left")


def _narrow(docs: DataFrame, seed: str, long: int | None) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), _source().alias("s"), _weight(long).alias("w"), _u(seed).alias("u"))


def _copies(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds the copies of each row. Where a sample ends among rows of equal rank, these are numbered."""
    rows = _drawn(_with(rows, ends))
    last = (F.col("q") == F.col("cut_q")) & (F.col("id") == F.col("cut_id"))
    upto = F.coalesce((F.col("q") < F.col("cut_q")) | ((F.col("q") == F.col("cut_q")) & (F.col("id") <= F.col("cut_id"))), F.lit(False))
    clear = lambda df: df.withColumn("copies", F.col("certain") + upto.cast("long"))
    if not ends.where("cut_rest < cut_n").limit(1).count():
        return clear(rows)
    split = F.coalesce(last & (F.col("cut_rest") < F.col("cut_n")), F.lit(False))
    tied = cut(rows.where(split).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))))
    before = Window.partitionBy("s").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = tied.groupBy("s", "salt").count().select("s", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    at = F.row_number().over(Window.partitionBy("s", "salt").orderBy("id")) + F.col("before")
    numbered = tied.join(counts, ["s", "salt"]).withColumn("copies", F.col("certain") + (at <= F.col("cut_rest")).cast("long"))
    return clear(rows.where(~split)).unionByName(numbered.drop("salt", "before"))


def sample(docs: DataFrame, targets: dict[str, float] | None = None, fraction: float = 1.0, seed: str = SEED, long: int | None = None) -> DataFrame:
    """The sample as (doc_id, source, copies), copies at least 1.

    ``targets``: the weight of each source (None: all alike; a source not named gets nothing).
    ``fraction``: rows of the sample for each row of the table. ``long``: characters beyond which a longer text
    weighs no more (None: no such bound)."""
    narrow = cut(_narrow(docs, seed, long))
    ends = cut(_cuts(narrow, cut(_sizes(narrow, targets, fraction))))
    rows = _copies(narrow, ends).where("copies > 0")
    return rows.select("doc_id", F.when(F.col("s") != "", F.substring("s", 2, 1 << 30)).alias("source"), "copies")


def mix(docs: DataFrame, targets: dict[str, float] | None = None, fraction: float = 1.0, seed: str = SEED, long: int | None = None) -> DataFrame:
    """The sample as documents, each as often as it was drawn, with the columns of ``docs``."""
    narrow = cut(_narrow(docs, seed, long))
    ends = cut(_cuts(narrow, cut(_sizes(narrow, targets, fraction))))
    # Only one row a source is joined: the texts themselves aren't moved.
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), _source().alias("s"), _weight(long).alias("w"), _u(seed).alias("u"))
    rows = _copies(own, ends).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS s, coalesce(length(text), 0)::BIGINT AS w,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '') || '{SEED}'), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u FROM documents),
z AS (SELECT s, sum(w)::BIGINT AS total, count(*) AS n FROM d GROUP BY s),
x AS (SELECT s, total, sum(n) OVER () AS size, (sum(n) OVER ())::DOUBLE * (total > 0)::BIGINT::DOUBLE / greatest(sum((total > 0)::BIGINT) OVER (), 1)::DOUBLE AS due FROM z),
y AS (SELECT s, total, (floor(due) + (total > 0 AND row_number() OVER (ORDER BY total > 0 DESC, due - floor(due) DESC, s) <= size - sum(floor(due)) OVER ())::BIGINT)::BIGINT AS n_s FROM x),
e AS (SELECT doc_id, source, s, u, n_s, (n_s * w)::DOUBLE / greatest(total, 1)::DOUBLE AS e FROM d JOIN y USING (s)),
p AS (SELECT *, floor(e)::BIGINT AS certain, e - floor(e) AS p FROM e),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q, n_s - sum(certain) OVER (PARTITION BY s) AS m FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY q NULLS LAST, doc_id) AS k FROM q)
SELECT doc_id, source, (certain + CASE WHEN q IS NOT NULL AND k <= m THEN 1 ELSE 0 END)::BIGINT AS copies FROM r WHERE certain + CASE WHEN q IS NOT NULL AND k <= m THEN 1 ELSE 0 END > 0
"""
