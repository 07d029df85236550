"""Registered queries: weights, pooling, vectors, link candidates.  Float sums are rounded to 6 digits, as their order is free."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import pooling as pl
from .fixtures import ctes, relation
from .registry import query

A, O = ctes("attrs"), ctes("obs")  # noqa: E741
_GATE = lambda x, lo, hi: f"least(1.0::double, greatest(0.0::double, ({x} - {lo}) / ({hi} - {lo})))"
_W = f"wt as (select *, quality * {_GATE('size_px', '32.0::double', '96.0::double')} * (1.0 - {_GATE('occ', '0.15::double', '0.6::double')}) * {_GATE('sharp', '0.05::double', '0.4::double')} * greatest(0.0::double, 1.0 - entropy) base from attrs), ww as (select *, case when base >= 0.8 then base * 3.0 else base end w from wt)"
_POOL = f"""{_W}, pool as (select clip_id, tid, 1 + sum(w * p) alpha, 1 + sum(w * (1 - p)) beta, coalesce(sum(case when age_mean is not null then w / greatest(1.0, age_std) / greatest(1.0, age_std) end), 0.0) prec,
  coalesce(sum(case when age_mean is not null then w / greatest(1.0, age_std) / greatest(1.0, age_std) * age_mean end), 0.0) pm, coalesce(sum(case when age_mean is not null then w end), 0.0) age_w, count(*) n from ww where base > 1e-4 group by 1, 2)"""
_READ = """rd as (select *, alpha / (alpha + beta) p, 1.96 * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) half, alpha + beta - 2 evidence, case when prec > 0 and age_w >= 0.05 then pm / prec end age, case when prec > 0 and age_w >= 0.05 then 1 / sqrt(prec) end age_std from {src}),
  ro as (select *, greatest(0.0, p - half) p_low, least(1.0, p + half) p_high, case when evidence >= 8 and p >= 0.9 then 1 when evidence >= 8 and p <= 0.1 then 2 end locked_side, case when evidence < 1 or age is null then null when age + age_std < 13 then 'child' else 'adult' end cls from rd)"""


def _round(df, *cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _r(*cols):
    return ", ".join(f"round({c}, 6) {c}" for c in cols)


@query("p08_gate", f"{A} select clip_id, tid, f, {_GATE('size_px', '32.0::double', '96.0::double')} g, case when occ >= 0.3 then 1.0::double else 0.0::double end step from attrs")
def _(spark, d):
    return relation(spark, d, "attrs").select("clip_id", "tid", "f", sc.gate(F.col("size_px"), 32.0, 96.0).alias("g"), sc.gate(F.col("occ"), 0.3, 0.3).alias("step"))


@query("p09_observation_weight", f"{A}, {_W} select clip_id, tid, f, base, w from ww")
def _(spark, d):
    return pl.weighted(relation(spark, d, "attrs")).select("clip_id", "tid", "f", "base", "w")


@query("p12_sharpness", f"{O} select clip_id, tid, f, case when eid % 130 < 64 then 0.0::double else least(1.0::double, (eid % 250) / 100.0::double) end sharp from obs")
def _(spark, d):
    e = F.col("eid")
    return relation(spark, d, "obs").select("clip_id", "tid", "f", sc.sharpness((e % 250).cast("double"), e % 130).alias("sharp"))


@query("a08_pool", f"{A}, {_POOL} select clip_id, tid, {_r('alpha', 'beta', 'prec', 'pm', 'age_w')}, n from pool")
def _(spark, d):
    return _round(pl.pool(relation(spark, d, "attrs")), "alpha", "beta", "prec", "pm", "age_w")


@query("a09_merge_profiles", f"{A}, {_POOL} select clip_id, round(sum(alpha - 1) + 1, 6) alpha, round(sum(beta - 1) + 1, 6) beta, round(sum(prec), 6) prec, round(sum(pm), 6) pm, round(sum(age_w), 6) age_w, sum(n)::bigint n from pool group by 1")
def _(spark, d):
    return _round(pl.merge_profiles(pl.pool(relation(spark, d, "attrs")), ("clip_id",)), "alpha", "beta", "prec", "pm", "age_w")


@query("a10_profile_class", f"{A}, {_POOL}, {_READ.format(src='pool')} select clip_id, tid, round(age, 4) age, round(age_std, 4) age_std, round(evidence, 4) evidence, locked_side, cls from ro")
def _(spark, d):
    out = pl.read_out(pl.pool(relation(spark, d, "attrs")))
    return _round(out.select("clip_id", "tid", "age", "age_std", "evidence", "locked_side", "cls"), "age", "age_std", "evidence", digits=4)


@query("p28_beta_interval", f"{A}, {_POOL}, {_READ.format(src='pool')} select clip_id, tid, {_r('p', 'p_low', 'p_high')} from ro")
def _(spark, d):
    return _round(pl.read_out(pl.pool(relation(spark, d, "attrs"))).select("clip_id", "tid", "p", "p_low", "p_high"), "p", "p_low", "p_high")


@query("l02_profile_selector", f"{A}, {_POOL}, {_READ.format(src='pool')} select clip_id, tid, cls from ro where cls is not null and cls <> 'child' and (p >= 0.48 or coalesce(locked_side = 1, false))")
def _(spark, d):
    from ..operators.votes import profile_selected

    return profile_selected(pl.read_out(pl.pool(relation(spark, d, "attrs"))), True, 0.48).select("clip_id", "tid", "cls")


_VECS = "v as (select cast(vec_id % 8 as int) clip_id, cast(vec_id as int) tid, cast(label as int) as label, embedding vec, (1 + vec_id % 4)::double w from embeddings)"


def _vecs(spark, d):
    e = relation(spark, d, "embeddings")
    return e.select((F.col("vec_id") % 8).cast("int").alias("clip_id"), F.col("vec_id").cast("int").alias("tid"), F.col("label").cast("int").alias("label"), F.col("embedding").alias("vec"), (1 + F.col("vec_id") % 4).cast("double").alias("w"))


def _mean_sql(weight: str) -> str:
    return f"""with {_VECS}, l as (select clip_id, label, unnest(range(1, len(vec) + 1)) pos, unnest(vec)::double x, {weight} w from v), m as (select clip_id, label, pos, sum(w * x) / sum(w) m from l group by 1, 2, 3),
  n as (select clip_id, label, sqrt(sum(m * m)) n from m group by 1, 2) select clip_id, label, pos - 1 as pos, round(m / n, 6) x from m join n using (clip_id, label)"""


def _long(df):
    return df.select("clip_id", "label", F.posexplode("vec").alias("pos", "x")).select("clip_id", "label", F.col("pos").cast("long").alias("pos"), F.round("x", 6).alias("x"))


@query("p13_unit_mean", _mean_sql("1.0::double"))
def _(spark, d):
    return _long(pl.mean_vector(_vecs(spark, d), ("clip_id", "label")))


@query("a25_weighted_mean_vector", _mean_sql("w"))
def _(spark, d):
    return _long(pl.mean_vector(_vecs(spark, d), ("clip_id", "label"), "w"))


@query("p14_cosine_pairs", f"with {_VECS} select a.clip_id, a.tid tid_a, b.tid tid_b, round(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: z[1]::double * z[2]::double)), 6) cos from v a join v b on a.clip_id = b.clip_id and a.tid < b.tid where list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: z[1]::double * z[2]::double)) >= 0.3")
def _(spark, d):
    return _round(pl.similar_pairs(_vecs(spark, d).select("clip_id", "tid", "vec"), 0.3), "cos")


_DOT = lambda a, b: f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::double * z[2]::double))"
_SEG = f"""{O}, {_VECS}, vel as (select *, (tid * 10 + f // 25)::int sid, (x1+x2)/2 cx, (y1+y2)/2 cy, first_value((x1+x2)/2) over w ax, first_value((y1+y2)/2) over w ay, first_value(f) over w af from obs window w as (partition by clip_id, tid, f // 25 order by f rows between 4 preceding and current row)),
  seg as (select clip_id, tid, sid, min(f) first_f, max(f) last_f, arg_min(cx, f) cx1, arg_min(cy, f) cy1, arg_max(cx, f) cx2, arg_max(cy, f) cy2, arg_max(y2 - y1, f) h2, arg_max((cx - ax) / greatest(1, f - af), f) vx, arg_max((cy - ay) / greatest(1, f - af), f) vy, case tid % 3 when 0 then null when 1 then 'a' else 'b' end cls, tid % 5 n_face from vel group by 1, 2, 3),
  slots as (select distinct on (clip_id, tid % 40) clip_id c2, tid % 40 slot, vec from v order by clip_id, tid % 40, tid),
  s as (select seg.*, case when tid % 7 > 0 then face.vec end fv, case when tid % 11 > 0 then body.vec end bv from seg left join slots face on face.c2 = clip_id and face.slot = tid % 40 left join slots body on body.c2 = clip_id and body.slot = (tid * 3 + 1) % 40),
  p as (select a.clip_id, a.sid sid_a, b.sid sid_b, {_DOT("a.fv", "b.fv")} fs, {_DOT("a.bv", "b.bv")} bs, least(a.n_face, b.n_face) faces, a.cls ac, b.cls bc, case when a.first_f <= b.first_f then a else b end x, case when a.first_f <= b.first_f then b else a end y from s a join s b on a.clip_id = b.clip_id and a.sid < b.sid
    where not exists (select 1 from vel i join vel j using (clip_id, f) where i.clip_id = a.clip_id and i.sid = a.sid and j.sid = b.sid)),
  g as (select *, greatest(0, y.first_f - x.last_f) gap from p),
  how as (select *, case when fs >= 0.45 and faces >= 2 then 'face' when bs >= 0.85 and gap / 25.0 <= 3 and sqrt((x.cx2 + x.vx * gap - y.cx1) ** 2 + (x.cy2 + x.vy * gap - y.cy1) ** 2) <= 1.5 * x.h2 + 0.1 * 1300 * gap / 25.0 and (ac is null or bc is null or ac = bc) then 'body' when bs >= 0.75 and gap / 25.0 <= 3 then 'near_miss' end how from g)
  select clip_id, sid_a, sid_b, how, round(case when how = 'face' then fs + 1 else bs end, 6) score from how where how is not null"""


def segments(spark, d):
    """Tracks cut every 25 frames, with their runs, box ends, velocity, class and two borrowed vectors: input of the linking
    operators.  Tracks have holes, so that some segments lie in the holes of others."""
    from pyspark.sql import Window

    obs = relation(spark, d, "obs").withColumn("k", F.floor(F.col("f") / 25))
    w = Window.partitionBy("clip_id", "tid", "k").orderBy("f").rowsBetween(-4, 0)
    obs = obs.withColumn("cx", (F.col("x1") + F.col("x2")) / 2).withColumn("cy", (F.col("y1") + F.col("y2")) / 2)
    dt = F.greatest(F.lit(1), F.col("f") - F.first("f").over(w))
    obs = obs.withColumn("vx", (F.col("cx") - F.first("cx").over(w)) / dt).withColumn("vy", (F.col("cy") - F.first("cy").over(w)) / dt).withColumn("h", F.col("y2") - F.col("y1"))
    at = lambda c, last: (F.max_by if last else F.min_by)(c, "f")
    seg = obs.groupBy("clip_id", "tid", "k").agg(F.min("f").alias("first_f"), F.max("f").alias("last_f"), F.count(F.lit(1)).alias("n"), F.collect_list("f").alias("fs"), at("cx", 0).alias("cx1"), at("cy", 0).alias("cy1"), at("cx", 1).alias("cx2"), at("cy", 1).alias("cy2"), at("h", 1).alias("h2"), at("h", 0).alias("h1"), at("vx", 1).alias("vx"), at("vy", 1).alias("vy"), F.min_by(F.struct("x1", "y1", "x2", "y2"), "f").alias("box1"), F.max_by(F.struct("x1", "y1", "x2", "y2"), "f").alias("box2"))
    seg = seg.withColumn("runs", sc.runs_of(F.col("fs"))).drop("fs")
    seg = seg.withColumn("sid", (F.col("tid") * 10 + F.col("k")).cast("int")).withColumn("cls", F.when(F.col("tid") % 3 == 1, "a").when(F.col("tid") % 3 == 2, "b")).withColumn("n_face", F.col("tid") % 5)
    slots = _vecs(spark, d).groupBy("clip_id", (F.col("tid") % 40).alias("slot")).agg(F.min_by("vec", "tid").alias("vec"))
    of = lambda slot, name: slots.select(F.col("clip_id").alias("of"), F.col("slot").alias(slot), F.col("vec").alias(name))
    for slot, name, held in ((F.col("tid") % 40, "face_vec", F.col("tid") % 7 > 0), ((F.col("tid") * 3 + 1) % 40, "body_vec", F.col("tid") % 11 > 0)):
        v = of(f"{name}_slot", name)
        seg = seg.withColumn("slot", slot).join(v, (F.col("clip_id") == F.col("of")) & (F.col("slot") == F.col(f"{name}_slot")), "left").drop("of", "slot", f"{name}_slot").withColumn(name, F.when(held, F.col(name)))
    return seg


@query("j12_link_candidates", _SEG)
def _(spark, d):
    return _round(pl.link_candidates(segments(spark, d), 25.0, 1300.0), "score")


@query("t02_near_misses", f"select * from ({_SEG}) where how = 'near_miss' qualify row_number() over (partition by clip_id order by score desc, sid_a desc, sid_b desc) <= 40")
def _(spark, d):
    return pl.best_near_misses(_round(pl.link_candidates(segments(spark, d), 25.0, 1300.0), "score")).drop("place")


@query("t05_candidate_order", f"select clip_id, sid_a, sid_b, score, row_number() over (partition by clip_id order by score desc, sid_a desc, sid_b desc) place from ({_SEG}) where how <> 'near_miss'")
def _(spark, d):
    from pyspark.sql import Window

    c = _round(pl.link_candidates(segments(spark, d), 25.0, 1300.0), "score").filter("how <> 'near_miss'")
    return c.select("clip_id", "sid_a", "sid_b", "score", F.row_number().over(Window.partitionBy("clip_id").orderBy(F.desc("score"), F.desc("sid_a"), F.desc("sid_b"))).cast("long").alias("place"))


_DIST = "dd as (select clip_id, tid, f, (eid % 60)::double age, (3 + eid % 5)::double sd from obs), g as (select clip_id, tid, f, a, exp(-(a - age) * (a - age) / (2 * sd * sd)) e from dd, range(0, 101) t(a)), p as (select clip_id, tid, f, a, e / sum(e) over (partition by clip_id, tid, f) p from g)"


@query("p25_p26_age_distribution", f"{O}, {_DIST}, m as (select clip_id, tid, f, sum(p * a) mean, sum(p * a * a) sq from p group by 1, 2, 3) select clip_id, tid, f, round(mean, 6) mean, round(sqrt(greatest(1.0, sq - mean * mean)), 6) std from m")
def _(spark, d):
    return _age_distribution(relation(spark, d, "obs"))


_STATS = "m as (select clip_id, tid, f, sum(p * a) mean, sum(p * a * a) sq from p group by 1, 2, 3) select clip_id, tid, f, round(mean, 6) mean, round(sqrt(greatest(1.0, sq - mean * mean)), 6) std from m"


def _age_distribution(obs):
    p = sc.gaussian_target((F.col("eid") % 60).cast("double"), (3 + F.col("eid") % 5).cast("double"))
    out = obs.select("clip_id", "tid", "f", p.alias("p")).select("clip_id", "tid", "f", sc.distribution_stats(F.col("p")).alias("s"))
    return _round(out.select("clip_id", "tid", "f", F.col("s.mean").alias("mean"), F.col("s.std").alias("std")), "mean", "std")


@query("p25_p26_age_distribution_all", f"{O}, {_DIST.replace(' where f % 10 = 0', '')}, {_STATS}")
def _(spark, d):
    return _age_distribution(relation(spark, d, "obs"))


@query("p27_p30_softmax_entropy", f"{O}, z as (select clip_id, tid, f, unnest([eid % 7, eid % 5, eid % 3]::double[]) z, unnest([0, 1, 2]) k from obs), e as (select *, exp(z - max(z) over (partition by clip_id, tid, f)) e from z), p as (select *, e / sum(e) over (partition by clip_id, tid, f) p from e) select clip_id, tid, f, round(max(case when k = 0 then p end), 6) p0, round(-sum(p * ln(p)) / ln(3.0), 6) entropy from p group by 1, 2, 3")
def _(spark, d):
    e = F.col("eid")
    obs = relation(spark, d, "obs").select("clip_id", "tid", "f", sc.softmax(F.array(*[(e % m).cast("double") for m in (7, 5, 3)])).alias("p"))
    return _round(obs.select("clip_id", "tid", "f", F.col("p")[0].alias("p0"), sc.entropy_share(F.col("p")).alias("entropy")), "p0", "entropy")


@query("a27_similarity_percentiles", f"{O}, s as (select clip_id, (eid % 1000) / 1000.0::double s from obs) select clip_id, count(*) n, quantile_cont(s, 0.05) p05, quantile_cont(s, 0.5) p50 from s group by 1")
def _(spark, d):
    s = relation(spark, d, "obs").select("clip_id", ((F.col("eid") % 1000) / F.lit(1000.0)).alias("s"))
    return s.groupBy("clip_id").agg(F.count(F.lit(1)).alias("n"), F.percentile("s", F.lit(0.05)).alias("p05"), F.percentile("s", F.lit(0.5)).alias("p50"))


_LOCKED = """v as materialized (select clip_id, tid, row_number() over (partition by clip_id, tid order by f) k, p, age_mean, age_std, w from ww where base > 1e-4),
  fold as (select clip_id, tid, 0::bigint k, 1.0::double alpha, 1.0::double beta, 0.0::double prec, 0.0::double pm, 0.0::double age_w, 0 locked from v where k = 1
    union all select clip_id, tid, k, alpha, beta, prec, pm, age_w, case when locked <> 0 or alpha + beta - 2 < 8 then locked when alpha / (alpha + beta) >= 0.9 then 1 when alpha / (alpha + beta) <= 1 - 0.9::double then 2 else 0 end
    from (select clip_id, tid, k, locked, alpha + u * p alpha, beta + u * (1 - p) beta, prec + coalesce(iv, 0) prec, pm + coalesce(iv * age_mean, 0) pm, age_w + case when age_mean is null then 0 else u end age_w
      from (select *, case when age_mean is not null then u / (greatest(1.0, age_std) * greatest(1.0, age_std)) end iv
        from (select o.* exclude (k), v.k, v.p, v.age_mean, v.age_std, v.w * case when locked <> 0 and case when v.p >= 0.5 then 1 else 2 end <> locked and v.w < 0.8 then 0.2::double else 1.0::double end u
          from fold o join v on o.clip_id = v.clip_id and o.tid = v.tid and v.k = o.k + 1))))"""


@query("a08_pool_locked", f"{A}, {_W}, {_LOCKED} select clip_id, tid, {_r('alpha', 'beta', 'prec', 'pm', 'age_w')}, k n, locked from fold where k > 0 qualify row_number() over (partition by clip_id, tid order by k desc) = 1")
def _(spark, d):
    return _round(pl.pool_locked(relation(spark, d, "attrs")), "alpha", "beta", "prec", "pm", "age_w")


