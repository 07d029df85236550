"""Registered queries: sources, sinks, lookups and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import scalars as sc
from ..operators import intervals as iv
from ..operators import pairs as pr
from ..operators import sequences as seq
from ..sources import tracks as tr
from . import sqltext as q
from .fixtures import ctes, relation
from .registry import query

O = ctes("obs")  # noqa: E741
_BOX = ("x1", "y1", "x2", "y2")


@query("s01_clip_meta", f"{O} select clip_id, case when (count(*) % 300) between 1 and 240 then (count(*) % 300)::double else 30.0::double end fps, max(f) + 1 n_frames from obs group by clip_id")
def _(spark, d):
    m = relation(spark, d, "obs").groupBy("clip_id").agg((F.count(F.lit(1)) % 300).cast("double").alias("fps"), (F.max("f") + 1).alias("n_frames"))
    return tr.clip_meta(m)


@query("s02_wanted_frames", f"{O} select clip_id, tid, f from obs where f % 7 = 3")
def _(spark, d):
    obs = relation(spark, d, "obs")
    return tr.wanted_frames(obs.select("clip_id", "tid", "f"), obs.filter("f % 7 = 3").select("clip_id", "f").distinct())


@query("s07_json_round_trip", f"{O} select clip_id, f, tid, x1, y1, x2, y2, score from obs")
def _(spark, d):
    obs = relation(spark, d, "obs").select("clip_id", "f", "tid", F.array(*_BOX).alias("box"), "score")
    back = obs.select(F.from_json(F.to_json(F.struct("*")), tr.FLAT).alias("r")).select("r.*")
    return back.select("clip_id", "f", "tid", *[F.col("box")[i].alias(c) for i, c in enumerate(_BOX)], "score")


@query("r02_nested_frames", f"{O} select clip_id, f, tid, x1, y1, x2, y2, score from obs")
def _(spark, d):
    obs = relation(spark, d, "obs")
    nested = obs.groupBy("clip_id", "f").agg(F.collect_list(F.struct("tid", F.array(*_BOX).alias("box"), F.col("score").alias("conf"))).alias("objs"))
    return tr.flatten_nested(nested)


@query("r05_raw_detections", f"{O} select clip_id, f, (row_number() over (partition by clip_id, f order by tid) - 1)::int det, x1, y1, x2, y2, score from obs")
def _(spark, d):
    obs = relation(spark, d, "obs").groupBy("clip_id", "f").agg(F.array_sort(F.collect_list(F.struct("tid", F.array(*_BOX).alias("box"), "score"))).alias("o"))
    return tr.flatten_detections(obs.select("clip_id", "f", F.col("o.box").alias("boxes"), F.col("o.score").alias("scores")))


@query("s09_parse_mot", f"{O}, c as (select clip_id, f, tid, greatest(0.0, least(x1 - 200, 900.0)) x1, greatest(0.0, least(y1, 400.0)) y1, greatest(0.0, least(x2 - 200, 900.0)) x2, greatest(0.0, least(y2, 400.0)) y2, score from obs where eid % 13 <> 0) select clip_id, f, tid, x1::double x1, y1::double y1, x2::double x2, y2::double y2, score from c where x2 - x1 >= 1 and y2 - y1 >= 1")
def _(spark, d):
    obs = relation(spark, d, "obs").withColumns({"x1": F.col("x1") - 200, "x2": F.col("x2") - 200})
    lines = tr.mot_lines(obs.filter("eid % 13 <> 0")).select("clip_id", "value").unionByName(obs.filter("eid % 13 = 0").select("clip_id", F.lit("7,1,2").alias("value")))
    return tr.parse_mot(lines, 900.0, 400.0)


@query("s13_mot_lines", f"{O} select clip_id, f, tid, (f + 1) || ',' || tid || ',' || format('{{:.1f}}', x1) || ',' || format('{{:.1f}}', y1) || ',' || format('{{:.1f}}', x2 - x1) || ',' || format('{{:.1f}}', y2 - y1) || ',' || format('{{:.4f}}', score) || ',-1,-1,-1' as value from obs")
def _(spark, d):
    return tr.mot_lines(relation(spark, d, "obs"))


@query("s10_detections_by_frame", f"{O} select clip_id, f, count(*) n, string_agg(tid::varchar, ',' order by tid) tids from obs group by 1, 2")
def _(spark, d):
    df = tr.detections_by_frame(relation(spark, d, "obs"))
    return df.select("clip_id", "f", F.size("detections").cast("long").alias("n"), F.array_join(F.col("detections.tid").cast("array<string>"), ",").alias("tids"))


@query("s12_proposal_lines", f"{O} select 'clip' || clip_id || '/img1/' || lpad((f + 1)::varchar, 8, '0') || '.txt' as name, string_agg(format('{{:.1f}},{{:.1f}},{{:.1f}},{{:.1f}},{{:.2f}}', x1, y1, x2 - x1, y2 - y1, score), ';' order by tid) lines from obs group by 1")
def _(spark, d):
    return tr.proposal_lines(relation(spark, d, "obs"), F.concat(F.lit("clip"), F.col("clip_id").cast("string")))


@query("r03_dedup_observations", f"{O}, b as (select clip_id, f, tid % 4 tid, x1, score from obs) select clip_id, f, tid, x1, score, n > 1 repeated from (select *, count(*) over (partition by clip_id, f, tid) n, row_number() over (partition by clip_id, f, tid order by score desc, x1 desc) r from b) where r = 1")
def _(spark, d):
    return tr.dedup_observations(relation(spark, d, "obs").select("clip_id", "f", (F.col("tid") % 4).alias("tid"), "x1", "score"))


@query("s14_manifest", "select 'img' || event_id as path, case when event_id % 4 <> 0 then (event_id % 90)::double end age, (event_id % 90 - 2)::double age_lo, (event_id % 90 + 3)::double age_hi, case when event_id % 3 <> 0 then (event_id % 2)::int end as label from events where event_id % 10 <> 0 and event_id % 90 <> 1")
def _(spark, d):
    e = F.col("event_id")
    known = F.concat_ws(",", F.concat(F.lit("img"), e), F.when(e % 4 == 0, F.lit(-1)).otherwise(e % 90), e % 90 - 2, e % 90 + 3, F.when(e % 3 == 0, F.lit(-1)).otherwise(e % 2))
    lines = relation(spark, d, "events").filter(e % 90 != 1).select(F.when(e % 10 == 0, "broken,row").otherwise(known).alias("value"))
    return tr.manifest(lines)


@query("s15_manifest_from_names", "select 'a/' || (event_id % 99) || '_' || (event_id % 3) || '_' || event_id || '.jpg' as path, (event_id % 99)::int age, (event_id % 3)::int as label from events where event_id % 3 < 2 and event_id % 5 <> 0")
def _(spark, d):
    e = F.col("event_id")
    age = F.when(e % 5 == 0, "x").otherwise((e % 99).cast("string"))
    return tr.manifest_from_names(relation(spark, d, "events").select(F.concat(F.lit("a/"), age, F.lit("_"), e % 3, F.lit("_"), e, F.lit(".jpg")).alias("path")))


@query("s16_export_groups", "with g as (select event_id, event_id % 90 age, case when event_id % 90 < 13 then '-12' when event_id % 90 < 20 then '13-19' when event_id % 90 < 30 then '20-29' when event_id % 90 < 45 then '30-44' when event_id % 90 < 65 then '45-64' else '65-' end grp from events) select * from g qualify row_number() over (partition by grp order by event_id) <= 50")
def _(spark, d):
    g = relation(spark, d, "events").select("event_id", (F.col("event_id") % 90).alias("age"))
    return tr.first_n_per_group(g.withColumn("grp", tr.age_group(F.col("age"))), ["grp"], ["event_id"], 50)


@query("g09_union_by_name", f"{O} select clip_id, tid, f, score, null::varchar src from obs where f % 2 = 0 union all select clip_id, tid, f, null, 'det' from obs where f % 2 = 1")
def _(spark, d):
    obs = relation(spark, d, "obs")
    a, b = obs.filter("f % 2 = 0").select("clip_id", "tid", "f", "score"), obs.filter("f % 2 = 1").select("clip_id", "tid", "f", F.lit("det").alias("src"))
    return a.unionByName(b, allowMissingColumns=True)


@query("g08_tiles", f"{O} select distinct clip_id, f, ox::int ox, oy::int oy from obs, (select unnest([0, 400, 800, 860]) ox), (select unnest([0, 360]) oy)")
def _(spark, d):
    return tr.tiles(1300, 800, 440, 40, relation(spark, d, "obs").select("clip_id", "f").distinct())


@query("g08_tiles_all", f"{O} select distinct clip_id, f, ox::int ox, oy::int oy from obs, (select unnest([0, 400, 800, 860]) ox), (select unnest([0, 360]) oy)")
def _(spark, d):
    return tr.tiles(1300, 800, 440, 40, relation(spark, d, "obs").select("clip_id", "f").distinct())


@query("g08_tile_to_frame", f"{O} select clip_id, f, tid, x1 + 400 x1, y1 + 360 y1, x2 + 400 x2, y2 + 360 y2 from obs")
def _(spark, d):
    return tr.tile_to_frame(relation(spark, d, "obs").select("clip_id", "f", "tid", *_BOX, F.lit(400).alias("ox"), F.lit(360).alias("oy")))


@query("a24_detection_totals", f"{O}, c as (select clip_id, f, count(*) n from obs group by 1, 2) select clip_id, sum(n)::bigint detections, sum(n) / count(*) mean_per_frame, max(n) max_per_frame from c group by 1")
def _(spark, d):
    c = relation(spark, d, "obs").groupBy("clip_id", "f").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("clip_id").agg(F.sum("n").alias("detections"), (F.sum("n") / F.count(F.lit(1))).alias("mean_per_frame"), F.max("n").alias("max_per_frame"))


@query("j02_inner_lookup", f"{O} select clip_id, tid, f, (tid // 8)::int identity from obs where tid % 5 <> 0")
def _(spark, d):
    obs = relation(spark, d, "obs")
    bridge = obs.select("clip_id", "tid").distinct().filter("tid % 5 <> 0").withColumn("identity", F.floor(F.col("tid") / 8).cast("int"))
    return obs.join(bridge, ["clip_id", "tid"]).select("clip_id", "tid", "f", "identity")


@query("j03_lookup_with_default", f"{O} select clip_id, tid, f, case when tid % 5 <> 0 then (tid // 8)::int else -1 end identity from obs")
def _(spark, d):
    obs = relation(spark, d, "obs")
    bridge = obs.select("clip_id", "tid").distinct().filter("tid % 5 <> 0").withColumn("identity", F.floor(F.col("tid") / 8).cast("int"))
    return obs.join(bridge, ["clip_id", "tid"], "left").select("clip_id", "tid", "f", F.coalesce("identity", F.lit(-1)).alias("identity"))


@query("j04_interval_lookup", f"""{O}, r as (select clip_id, tid, min(f) first_f, max(f) last_f from (select clip_id, tid, f, f - row_number() over (partition by clip_id, tid order by f) g from obs) group by clip_id, tid, g having count(*) >= 2),
  i as (select clip_id, tid, first_f - 1 first_f, last_f + 1 last_f, (tid * 100 + first_f)::int identity from r)
  select o.clip_id, o.tid, o.f, (select min(row(first_f, identity)).identity from i where i.clip_id = o.clip_id and i.tid = o.tid and o.f between i.first_f and i.last_f) identity from obs o""".replace("(select min(row(first_f, identity)).identity from i where", "(select arg_min(identity, first_f) from i where"))
def _(spark, d):
    obs = relation(spark, d, "obs").select("clip_id", "tid", "f")
    runs = seq.at_least(seq.runs(obs), 2)
    intervals = runs.select("clip_id", "tid", (F.col("first_f") - 1).alias("first_f"), (F.col("last_f") + 1).alias("last_f"), (F.col("tid") * 100 + F.col("first_f")).cast("int").alias("identity"))
    return iv.lookup(obs, intervals, ["clip_id", "tid"], "f", ("first_f", "last_f"), ["first_f"]).select("clip_id", "tid", "f", "identity")


@query("l05_canonical_identity", f"""{ctes("obs", "run_b")}, o as (select * from run_b), c as (select * from obs where tid % 3 > 0), m as (select a.clip_id, a.f, a.tid, b.tid host from o a join c b on a.clip_id = b.clip_id and a.f = b.f where {q.iou("a.", "b.")} >= 0.5 qualify row_number() over (partition by a.clip_id, a.f, a.tid order by {q.iou("a.", "b.")} desc, b.tid) = 1),
  h as (select clip_id, tid, host from m group by 1, 2, 3 qualify row_number() over (partition by clip_id, tid order by count(*) desc, host) = 1), l as (select clip_id, max(tid) as last from c group by 1),
  t as (select distinct clip_id, tid from o) select clip_id, tid, coalesce(host, coalesce(last, 0) + row_number() over (partition by clip_id, host is null order by tid))::bigint identity from t left join h using (clip_id, tid) left join l using (clip_id)""")
def _(spark, d):
    """Two thirds of the tracks are control tracks; the objects are those of another run."""
    return pr.canonical_identities(relation(spark, d, "run_b"), relation(spark, d, "obs").filter("tid % 3 > 0"))


@query("t07_frame_cap", f"{O} select clip_id, tid, f from obs where f < 37")
def _(spark, d):
    return relation(spark, d, "obs").filter(F.col("f") < F.floor(F.lit(1.5) * 25)).select("clip_id", "tid", "f")


@query("p19_filters", f"{O} select clip_id, tid, f from obs where least(x2 - x1, y2 - y1) >= 60 and f % 3 = 0 and score >= 0.4")
def _(spark, d):
    return relation(spark, d, "obs").filter((F.least(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) >= 60) & (F.col("f") % 3 == 0) & (F.col("score") >= 0.4)).select("clip_id", "tid", "f")


@query("p20_normalised_boxes", f"{O}, n as (select clip_id, tid, f, (x1 + x2) / 2 / 1300 cx, (y1 + y2) / 2 / 800 cy, (x2 - x1) / 1300 w, (y2 - y1) / 800 h from obs) select clip_id, tid, f, round((cx - w / 2) * 1300, 6) x1, round((cy - h / 2) * 800, 6) y1, round((cx + w / 2) * 1300, 6) x2, round((cy + h / 2) * 800, 6) y2 from n")
def _(spark, d):
    o = relation(spark, d, "obs")
    b = geo.box()
    cx, cy = geo.center(b)
    back = geo.from_cxcywh(cx / 1300, cy / 800, (b[2] - b[0]) / 1300, (b[3] - b[1]) / 800, 1300, 800)
    return o.select("clip_id", "tid", "f", *[F.round(x, 6).alias(c) for x, c in zip(back, _BOX, strict=True)])


@query("p21_colour_slot", "select event_id, (list_sum(list_transform(string_split(event_type, ''), lambda c: ascii(c))) % 12)::int slot from events")
def _(spark, d):
    return relation(spark, d, "events").select("event_id", sc.colour_slot(F.col("event_type"), 12).alias("slot"))


@query("p22_display_frame", f"{O} select clip_id, tid, f, (floor(floor((f * 0.04::double + 0.01) * 25.0) / 4) * 4)::int shown from obs")
def _(spark, d):
    return relation(spark, d, "obs").select("clip_id", "tid", "f", sc.display_frame(F.col("f") * F.lit(0.04) + F.lit(0.01), F.lit(25.0), 4).alias("shown"))


@query("p24_parse_spec", "select event_id, event_type as name, 'run/' || user_id || '.jsonl' as tracks from events")
def _(spark, d):
    e = relation(spark, d, "events")
    m = tr.parse_spec(F.concat(F.lit("name="), "event_type", F.lit(",tracks=run/"), F.col("user_id").cast("string"), F.lit(".jsonl")))
    return e.select("event_id", m.alias("m")).select("event_id", F.col("m")["name"].alias("name"), F.col("m")["tracks"].alias("tracks"))


@query("p31_stage_seconds", "select event_id log_id, case when event_id % 4 <> 0 then (event_id % 50 + 0.5)::double end track, (event_id % 9)::double vote from events")
def _(spark, d):
    e = F.col("event_id")
    track = F.when(e % 4 != 0, F.concat(F.lit("track: 1.0s track: "), e % 50, F.lit(".5s "))).otherwise("")
    return tr.stage_seconds(relation(spark, d, "events").select(e.alias("log_id"), F.concat(track, F.lit("vote: "), e % 9, F.lit("s")).alias("text")), ("track", "vote"))


@query("a30_timing", "with m as (select user_id % 5 run_id, event_type stage, (event_id % 64) / 64.0::double s, 1 + event_id % 3 n from events) select run_id, stage, sum(n)::bigint frames, round(sum(s) * 1000 / sum(n), 6) ms_per_frame, round(sum(n) / sum(s), 6) hz from m group by 1, 2")
def _(spark, d):
    m = relation(spark, d, "events").select((F.col("user_id") % 5).alias("run_id"), F.col("event_type").alias("stage"), ((F.col("event_id") % 64) / F.lit(64.0)).alias("seconds"), (1 + F.col("event_id") % 3).alias("frames"))
    return tr.timing(m).withColumns({c: F.round(c, 6) for c in ("ms_per_frame", "hz")})


@query("s20_clip_report", f"{O}, t as (select clip_id, tid, count(*) n, min(f) first_f, max(f) last_f from obs group by 1, 2) select clip_id, count(*) tracks, sum(n)::bigint rows_, max(n) longest, arg_max(tid, row(n, -tid)) longest_tid, min(first_f) first_f, max(last_f) last_f from t group by 1")
def _(spark, d):
    t = seq.spans(relation(spark, d, "obs"))
    return t.groupBy("clip_id").agg(F.count(F.lit(1)).alias("tracks"), F.sum("n").alias("rows_"), F.max("n").alias("longest"), F.max_by("tid", F.struct("n", (-F.col("tid")).alias("x"))).alias("longest_tid"), F.min("first_f").alias("first_f"), F.max("last_f").alias("last_f"))
