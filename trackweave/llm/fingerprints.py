"""Document fingerprints from closed syncmers (native: DataFrame functions only).

A text is a row of tokens: runs of non-space characters, cut every 16.  Of every k consecutive tokens
(k = 5) the inner substrings of s = 2 tokens are hashed; the k-mer is an anchor when the least of these
hashes lies at the first or the last place.  Whether a k-mer is an anchor depends on nothing but itself,
so equal passages have equal anchors wherever they stand, and the anchors' positions show how they match.

A fingerprint holds every anchor with every position at which it stands.  Likeness is Dice's share
2|A & B| / (|A| + |B|) of the two whole sets of anchors.

Scale
* Fingerprinting is one projection, without a shuffle.
* The next document (query op3) is found by dealing documents out by id range and looking one row ahead;
  the text is shuffled once.  Ranges come from byte counts of at most 65,536 equal id intervals; each range
  also gets a copy of the first row of the following one, so no window runs over all rows.

Defined cases: a null text is empty; the empty text has no anchors and is like itself (1) and unlike
everything else (0).  Texts of fewer than k tokens have one anchor, their token row.  Null ids come first.
Rows that repeat an id are ordered by their text.  An only document is its own next one.  An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, table

TOKEN = r"[^\x20\x09-\x0D]{1,16}"
K, S = 5, 2
CELLS, BUCKET_MB = 65_536, 16


def add_fingerprint(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Adds `name`: array of (hash, pos), ascending by hash and position."""
    h, g = f"{name}_h", f"{name}_g"
    n = F.size(h)
    at = lambda a, i, j: F.get(F.col(a), i + j)
    df = df.withColumn(h, F.transform(F.regexp_extract_all(text, F.lit(TOKEN), 0), lambda t: F.xxhash64(t)))
    # hashes of the inner substrings, by their first token
    starts = lambda length: F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(g, F.transform(starts(s), lambda i: F.xxhash64(*[at(h, i, j) for j in range(s)])))
    inner = range(1, k - s)
    edge = lambda i: F.least(at(g, i, 0), at(g, i, k - s))
    chosen = F.filter(starts(k), lambda i: edge(i) <= F.least(*[at(g, i, j) for j in inner]) if len(inner) > 1 else (edge(i) <= at(g, i, 1) if inner else F.lit(True)))
    anchors = F.transform(chosen, lambda i: F.struct(F.xxhash64(*[at(h, i, j) for j in range(k)]).alias("hash"), i.alias("pos")))
    short = F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("pos")))
    return df.withColumn(name, F.sort_array(F.when(n >= k, anchors).when(n > 0, short).otherwise(F.slice(short, 1, 0)))).drop(h, g)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two fingerprints."""
    left, right = F.array_distinct(a["hash"]), F.array_distinct(b["hash"])
    total = F.size(left) + F.size(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a["hash"], b["hash"])) / total.cast("double"))


def matched_positions(a: Column, b: Column) -> Column:
    """Pairs (pos in a, pos in b) of the anchors that both fingerprints hold, by position in a."""
    pairs = lambda x: F.transform(F.filter(b, lambda y: y["hash"] == x["hash"]), lambda y: F.struct(x["pos"].alias("a"), y["pos"].alias("b")))
    return F.sort_array(F.flatten(F.transform(a, pairs)))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.hex(x["hash"]), F.lit(":"), x["pos"].cast("string"))), " ")


def with_next(docs: DataFrame, bucket_mb: float = BUCKET_MB) -> DataFrame:
    """(doc_id, text) with `bucket` and halo rows, so that within a bucket, ordered by (halo, key, text), each row that
    is not a halo row is followed by the next document of the whole table; the last is followed by the first."""
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    low, high = keyed.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    width = (high - low) // CELLS + 1
    cell = F.coalesce(F.floor((F.col("doc_id") - F.lit(low).cast("decimal(20,0)")) / F.lit(width)).cast("int"), F.lit(-1))
    keyed = keyed.withColumn("cell", cell)
    sizes = keyed.groupBy("cell").agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.min("key").alias("first"))
    before = F.sum("bytes").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    cells = sizes.select("cell", "first", F.floor(before / (bucket_mb * 1e6)).cast("int").alias("bucket"))  # CELLS + 1 rows at most
    heads = cells.groupBy("bucket").agg(F.min("first").alias("first"))
    follows = Window.orderBy("bucket")
    wrap = F.first("first").over(follows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    halo = heads.select("bucket", F.coalesce(F.lead("first").over(follows), wrap).alias("key"))
    own = keyed.join(F.broadcast(cells.select("cell", "bucket")), "cell").select("bucket", F.lit(False).alias("halo"), "key", "doc_id", "text")
    return own.unionByName(keyed.join(F.broadcast(halo), "key").select("bucket", F.lit(True).alias("halo"), "key", "doc_id", "text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("bucket").orderBy("halo", "key", "text")
    rows = with_next(documents(table(spark, sf_dir, "documents"))).withColumn("next_text", F.lead("text").over(order))
    rows = add_fingerprint(rows, "text", "fp").withColumn("next_fp", F.lead("fp").over(order)).filter(~F.col("halo"))
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("half", F.floor(n / 2).cast("int"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("half")), F.substring("next_text", F.lit(1), F.col("half")))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    rows = add_fingerprint(rows, "edited", "edited_fp")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
