"""Mixing sources to target weights by systematic sampling.

Each document of a source has the same expected number of copies, rate = target words / source words.
Documents are put in order of size within their source, the expected copies are summed up as a prefix
sum, one offset per source (from a hash of its name and the seed) is added, and a document is emitted
once for each integer boundary its interval crosses.  As sizes rise along the order, what a source
gives differs from its target by less than about its largest document.

Targets: sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... of all words; a target stops
at `cap` times its source's words, and the excess is shared out again by weight until none is above.

Scale
* No window runs over a whole source.  The rank of a document is (documents of smaller sizes) + (documents
  of the same size in earlier salts) + (row number within source, size and salt); only the last needs
  the rows, in groups of 1/64 of the documents of one size or, beyond 64 million documents, a million at most.  The first two come from map-side combined
  counts, whose windows have one row per distinct size, or per salt.
* Sources are a dimension: one row each in a single window that sets the targets.

Defined cases: a null text has size 0; null sources are one source, sorted last.  Documents of size 0 have
copies but take no words.  Rows that repeat an id are drawn each for itself, in the order of a hash of their text.  A very long text counts whole;
other columns, whatever their names, are carried or ignored.  If there are no words, all
targets are 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, WORD_SQL, table

WEIGHTS = (5, 2, 1)
CAP = 3
SALTS, SALT_ROWS = 64, 1_000_000
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> with target.  The rows are sources, so one window over all of them is small."""
    everyone = Window.partitionBy(F.lit(0))
    by_name = everyone.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("k", F.row_number().over(by_name)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("k") - 1) % len(weights) + 1).cast("int")).cast("double"))
    most = cap * F.col("source_size")
    by_room = everyone.orderBy(most / F.col("weight"), "k")
    ranked = ranked.withColumn("full", F.coalesce(F.sum(most).over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("rest", F.sum("weight").over(by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing))).withColumn("total", F.sum("source_size").over(everyone))
    ranked = ranked.withColumn("level", (F.col("total") - F.col("full")) / F.col("rest")).withColumn("stops", F.col("level") > most / F.col("weight"))
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(everyone)
    return ranked.select("source", "source_size", F.when(F.col("stops"), most.cast("double")).otherwise(level * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, source; with `carry` also `row`, all its columns."""
    own = [F.struct(*docs.columns).alias("row")] if carry else []
    rows = docs.select(*own, F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text_col).alias("tie"))
    salts = max(SALTS, -(-docs.count() // SALT_ROWS))
    salt = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long") % salts, F.pmod("tie", F.lit(salts)), F.lit(0))
    rows = rows.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).withColumn("salt", salt)
    counts = rows.groupBy("name", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_size = counts.groupBy("name", "size").agg(F.sum("n").alias("n")).select("name", "size", before(Window.partitionBy("name").orderBy("size")).alias("smaller"))
    by_salt = counts.select("name", "size", "salt", before(Window.partitionBy("name", "size").orderBy("salt")).alias("earlier"))
    offsets = by_salt.join(by_size, ["name", "size"]).select("name", "size", "salt", (F.col("smaller") + F.col("earlier")).alias("skip"))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    targets = targets.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"), "source_size", "target")
    within = Window.partitionBy("name", "size", "salt").orderBy("doc_id", "tie")
    placed = rows.withColumn("within", F.row_number().over(within)).join(offsets, ["name", "size", "salt"]).join(targets, "name")
    # 16 random bits and a half: sums of whole copies and the offset are exact in a double
    start = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), "name")), 1, 4), 16, 10).cast("long") + F.lit(0.5)) / F.lit(65536.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("skip") + F.col("within")
    placed = placed.withColumn("start", start).withColumn("rate", rate).withColumn("rank", rank)
    crossed = F.floor(F.col("rank") * F.col("rate") + F.col("start")) - F.floor((F.col("rank") - 1) * F.col("rate") + F.col("start"))
    placed = placed.withColumn("copies", F.least(crossed.cast("long"), F.lit(cap).cast("long")))
    return placed.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "source", *(["row"] if carry else []))


def draw(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of `docs`, all columns unchanged, each as many times as it was drawn."""
    drawn = mix_sources(docs, carry=True, **options)
    return drawn.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def oracle(documents: str = "documents") -> str:
    """The same in DuckDB SQL over any relation with doc_id, text and source."""
    return f"""
with rows_ as (select doc_id, source, coalesce('=' || source, '') as name, case when text is null then 0 else len(regexp_extract_all(text, '{WORD_SQL}')) end::bigint as size from {documents}),
s as (select source, sum(size)::bigint source_size from rows_ group by source),
k as (select *, row_number() over (order by source is null, source) k from s),
w as (select *, case (k - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end weight from k),
f as (select *, coalesce(sum(3 * source_size) over (order by 3 * source_size / weight, k rows between unbounded preceding and 1 preceding), 0)::double full_,
  sum(weight) over (order by 3 * source_size / weight, k rows between current row and unbounded following) rest, sum(source_size) over ()::double total from w),
l as (select *, (total - full_) / rest as level_, (total - full_) / rest > 3 * source_size / weight stops from f),
t as (select coalesce('=' || source, '') as name, source_size, case when stops then (3 * source_size)::double else max(case when not stops then level_ end) over () * weight end target from l),
p as (select r.doc_id, r.size, r.source, t.source_size, t.target, row_number() over (partition by name order by size, ('0x' || substr(md5(doc_id::varchar), 1, 8))::bigint % (select greatest({SALTS}, ceil(count(*) / {SALT_ROWS})::bigint) from {documents}), doc_id) as rank_,
  case when source_size > 0 then target / source_size else 0.0::double end rate, (('0x' || substr(md5('{SEED}' || name), 1, 4))::bigint + 0.5::double) / 65536.0::double as start_ from rows_ r join t using (name)),
c as (select *, least((floor(rank_ * rate + start_) - floor((rank_ - 1) * rate + start_))::bigint, 3) copies from p)
select doc_id, size, source_size, target, copies, copies * size as taken, source from c
"""


ORACLE_SQL = oracle()
