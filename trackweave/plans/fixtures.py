"""Track relations derived from the `events` and `embeddings` tables by integer arithmetic.

The SQL is the same text for Spark and DuckDB, so that queries and their oracles start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OBS = """
select clip_id, tid, f, eid,
  cast((tid*37)%1100 + 2*f + case when eid%41=0 then 300 else eid%3 end as double) x1,
  cast((tid*53)%500 + eid%2 as double) y1,
  cast((tid*37)%1100 + 2*f + case when eid%41=0 then 300 else eid%3 end + 40 + (tid%5)*12 as double) x2,
  cast((tid*53)%500 + eid%2 + 100 + (tid%5)*30 as double) y2,
  cast(15 + eid%86 as double)/100.0e0 score
from (select cast(user_id % 8 as int) clip_id, cast(user_id as int) tid, cast(event_id % 100 as int) f, cast(min(event_id) as bigint) eid
      from events group by 1, 2, 3) e
"""

RUN_B = """
select clip_id, cast(case when f >= 50 and tid%3=0 then tid + 100000 else tid end as int) tid, f, eid, x1 + eid%7 x1, y1, x2 + eid%7 x2, y2, score
from obs where eid%11 <> 0
"""

LAYERS = """
select o.clip_id, o.tid, o.f, o.eid, o.x1, o.y1, o.x2, o.y2, o.score,
  e.event_type in ('view','click','error') and o.tid%10 <> 0 as has_a, e.event_type in ('error','purchase','signup') and o.tid%10 <> 0 as has_b
from obs o join events e on e.event_id = o.eid
"""

VOTES = """
select clip_id, tid, f, eid, case eid%20 when 0 then 'not_person' when 1 then 'depiction' else 'real_person' end verdict,
  case when has_a then 'a' when has_b then 'b' end label, case when eid%70 < 13 then 'child' else 'adult' end age_group,
  cast(eid%70 as double) age, case eid%4 when 0 then 0.0e0 when 1 then 0.5e0 when 2 then 1.0e0 else 2.0e0 end w, eid%3 = 0 face
from layers
"""

ATTRS = """
select clip_id, tid, f, eid, cast(eid%101 as double)/100.0e0 p, case when eid%9 <> 0 then cast(eid%80 as double) end age_mean, cast(4 + eid%9 as double) age_std,
  cast(50 + eid%51 as double)/100.0e0 quality, cast(eid%31 as double)/100.0e0 entropy, cast(20 + eid%100 as double) size_px, cast(eid%71 as double)/100.0e0 occ, cast(eid%61 as double)/100.0e0 sharp
from obs
"""

_CHAIN = {"obs": OBS, "run_b": RUN_B, "layers": LAYERS, "votes": VOTES, "attrs": ATTRS}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A relation by name: one of the derived ones, or a table of the data set."""
    if name not in _CHAIN:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sources = {t: relation(spark, sf_dir, t) for t in ("events", "obs", "layers") if f"from {t}" in _CHAIN[name] or f"join {t}" in _CHAIN[name]}
    sql = _CHAIN[name]
    for t in sources:
        sql = sql.replace(f"from {t}", f"from {{{t}}}").replace(f"join {t}", f"join {{{t}}}")
    return spark.sql(sql, **sources)


def ctes(*names: str) -> str:
    """`with` clause that defines the derived relations for DuckDB."""
    wanted, out = set(names), []
    for name in reversed(_CHAIN):
        if name in wanted:
            wanted |= {t for t in _CHAIN if f"from {t}" in _CHAIN[name] or f"join {t}" in _CHAIN[name]}
    for name, sql in _CHAIN.items():
        if name in wanted:
            out.append(f"{name} as ({sql})")
    return "with recursive " + ",\n".join(out)
