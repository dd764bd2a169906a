"""Registry of checked queries: for every operator a Spark query over the
scale-factor tables and the same computation as DuckDB SQL (the oracle).

Every query reads the whole tables. Doubles are rounded (6 places) on both
sides only because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.cohort import (
    calculate_index_dates,
    filter_events,
    split_alive_dead,
    validate_unique,
)
from cohortlens.operators.evaluation import auc, confusion_counts, roc_points
from cohortlens.operators.features import (
    aggregate_events,
    generate_feature_mapping,
    normalization,
    svmlight_convert,
    unmapped_codes,
    with_sample_id,
)
from cohortlens.operators.exact import exact_sum
from cohortlens.operators.linear import classify, score, train_gd, train_sgd, zero_weights
from cohortlens.operators.metrics import (
    common_codes,
    common_codes_by_class,
    encounter_count_metrics,
    event_count_metrics,
    patient_profile,
    record_length_metrics,
    top_codes,
)
from cohortlens.operators.split import hash_split, read_split, train_test_split
from cohortlens.plans.cohort_profile import cohort_profile
from cohortlens.plans.sample_build import build_samples, build_samples_colocated, colocated_counts
from cohortlens.sources.csv_events import (
    EVENTS_CSV_SCHEMA,
    MORTALITY_CSV_SCHEMA,
    ingest_events,
    ingest_mortality,
    read_events_checked,
    read_mortality_checked,
    source_report,
)
from cohortlens.sources.event_table import write_event_table
from cohortlens.sources.folders import new_folder, write_once
from cohortlens.sources.model_store import load_model, save_model
from cohortlens.sources.svmlight import bad_pairs, parse_svmlight, read_svmlight_checked, svmlight_report
from cohortlens.sources.tables import EV_SQL, MO_SQL, cohort_inputs, read_table

DIGITS = 6
# Learner parameters used by the checked queries.
Q_ETA = 0.5
Q_MU = 0.1
Q_GD_STEPS = 2
Q_SHARD_ROWS = 200

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def _r(c: str, alias: str | None = None):
    return F.round(F.col(c), DIGITS).alias(alias or c)


# ------------------------------------------------------------ SQL blocks --

BASE = f"""
ev as ({EV_SQL}),
mo as ({MO_SQL}),
tagged as (
  select e.patientid, e.eventid, e.etimestamp, e.value, m.label,
         case when m.label is null then 'alive' when m.label = 1 then 'dead' end as cohort
  from ev e left join (select patientid, label from mo) m on e.patientid = m.patientid)
"""

PROFILE = """
prof as (
  select cohort, patientid, count(*) as n_events,
         count(distinct etimestamp) as n_encounters,
         min(etimestamp) as first_date, max(etimestamp) as last_date,
         cast(datediff('day', min(etimestamp), max(etimestamp)) as int) as record_days
  from tagged where cohort is not null group by cohort, patientid),
summary as (
  select c.cohort,
         avg(n_events) as events_avg, min(n_events) as events_min, max(n_events) as events_max,
         avg(n_encounters) as encounters_avg, quantile_disc(n_encounters, 0.5) as encounters_median,
         min(n_encounters) as encounters_min, max(n_encounters) as encounters_max,
         avg(record_days) as days_avg, quantile_disc(record_days, 0.5) as days_median,
         min(record_days) as days_min, max(record_days) as days_max
  from (values ('alive'), ('dead')) c(cohort) left join prof p on p.cohort = c.cohort
  group by c.cohort)
"""

FEATURES = """
idx as (
  select e.patientid, max(e.etimestamp) as index_date
  from ev e left join (select patientid, label from mo) m on e.patientid = m.patientid
  where m.label is null group by e.patientid
  union all
  select patientid, cast(mtimestamp - 30 as date) as index_date from mo),
filtered as (
  select e.patientid, e.eventid, e.etimestamp, e.value
  from ev e join idx i on e.patientid = i.patientid
  where e.etimestamp between cast(i.index_date - 2000 as date) and i.index_date),
agg as (
  select patientid, eventid, count(eventid) as feature_value
  from filtered group by patientid, eventid),
emap as (
  select eventid, row_number() over (order by eventid) - 1 as event_index
  from (select distinct eventid from agg where eventid is not null)),
norm as (
  select a.patientid, a.eventid,
         round(cast(a.feature_value as double) / m.max_value, 3) as normalized_feature_value
  from agg a left join (select eventid, max(feature_value) as max_value from agg group by eventid) m
    on a.eventid = m.eventid),
svm as (
  select n.patientid,
         string_agg(cast(e.event_index as varchar) || ':' || printf('%.3f', n.normalized_feature_value),
                    ' ' order by e.event_index) as sparse_text
  from norm n join emap e on n.eventid = e.eventid
  where n.normalized_feature_value > 0
  group by n.patientid),
samples as (
  select s.patientid,
         concat(case when m.label = 1 then '1' else '0' end, ' ', s.sparse_text) as save_feature
  from svm s left join (select patientid, label from mo) m on s.patientid = m.patientid),
ids as (
  select patientid, save_feature,
         md5(concat_ws('|', cast(patientid as varchar), save_feature,
                       cast(row_number() over (partition by patientid, save_feature) as varchar))) as sample_id
  from samples)
"""

def _parsed_sql(src: str, name: str) -> str:
    """``{name}`` (sample_id, y, feature_index, feature_value) exploded from
    sample lines in table ``src``; ``{name}_y`` (sample_id, y) one row per
    line; ``{name}_n`` the line count."""
    return f"""
{name} as (
  select sample_id, cast(toks[1] as double) as y,
         cast(split_part(t, ':', 1) as int) as feature_index,
         cast(split_part(t, ':', 2) as double) as feature_value
  from (select sample_id, toks, unnest(toks[2:]) as t
        from (select sample_id, regexp_split_to_array(trim(save_feature), '\\s+') as toks
              from {src}))),
{name}_y as (
  select sample_id, cast(regexp_split_to_array(trim(save_feature), '\\s+')[1] as double) as y
  from {src}),
{name}_n as (select count(*) as n from {name}_y)
"""


def _gd_sql(parsed: str, prev: str, name: str, rule: str = "textbook") -> str:
    """One full-batch step over ``parsed`` from weights table ``prev``."""
    shrink = 1.0 - 2.0 * Q_ETA * Q_MU
    term = ("p.feature_value * (p.y - 1.0 / (1.0 + exp(-mm.m)))" if rule == "textbook"
            else "p.y - p.feature_value / (1.0 + exp(-abs(mm.m)))")
    return f"""
{name}_m as (
  select p.sample_id, sum(coalesce(w.weight, 0.0) * p.feature_value) as m
  from {parsed} p left join {prev} w on p.feature_index = w.feature_index
  group by p.sample_id),
{name}_g as (
  select p.feature_index, sum({term}) as g
  from {parsed} p join {name}_m mm on p.sample_id = mm.sample_id
  group by p.feature_index),
{name} as (
  select coalesce(o.feature_index, g.feature_index) as feature_index,
         (coalesce(o.weight, 0.0) + {Q_ETA} / (select n from {parsed}_n) * coalesce(g.g, 0.0))
           * {shrink} as weight
  from {prev} o full outer join {name}_g g on o.feature_index = g.feature_index)
"""


def _scored_sql(parsed: str, weights: str, name: str) -> str:
    return f"""
{name} as (
  select l.sample_id, l.y, coalesce(sum(w.weight * p.feature_value), 0.0) as margin
  from {parsed}_y l
  left join {parsed} p on l.sample_id = p.sample_id
  left join {weights} w on p.feature_index = w.feature_index
  group by l.sample_id, l.y)
"""


W0 = "w0 as (select cast(null as int) as feature_index, cast(null as double) as weight where false)"
PARSED = _parsed_sql("ids", "parsed")
GD = ",\n".join(b.strip() for b in (PARSED, W0, _gd_sql("parsed", "w0", "w1"),
                                     _gd_sql("parsed", "w1", "w2")))
GD_AS_CODED = ",\n".join(b.strip() for b in (PARSED, W0, _gd_sql("parsed", "w0", "c1", "as_coded"),
                                              _gd_sql("parsed", "c1", "c2", "as_coded")))
SCORED_SQL = _scored_sql("parsed", "w2", "scored")

_SPLIT_TEST = "substring(md5(cast(patientid as varchar) || ':48'), 1, 8) < '33333333'"

SPLIT_MODEL = ",\n".join(b.strip() for b in (
    f"train_s as (select * from ids where not ({_SPLIT_TEST}))",
    f"test_s as (select * from ids where {_SPLIT_TEST})",
    _parsed_sql("train_s", "ptrain"), _parsed_sql("test_s", "ptest"), W0,
    _gd_sql("ptrain", "w0", "t1"), _gd_sql("ptrain", "t1", "t2"),
    _scored_sql("ptest", "t2", "test_scored"),
    f"""tg as (
  select round(1.0 / (1.0 + exp(-margin)), 12) as score,
         sum(case when y = 1 then 1 else 0 end) as p,
         sum(case when y = 1 then 0 else 1 end) as n
  from test_scored group by 1)""",
    """tc as (
  select score, p, n,
         sum(p) over (order by score desc rows between unbounded preceding and current row) as cum_p
  from tg)"""))



def _sgd_sql(rule: str, order: str = "sample_id") -> str:
    """One pass of per-sample SGD in md5 shards, mixed: a shard's weights are a
    list that a recursive step takes from sample to sample."""
    move = (f"{Q_ETA} * coalesce(v[i], 0) * (y - 1.0 / (1.0 + exp(-m)))" if rule == "textbook"
            else f"case when v[i] is null then 0 else {Q_ETA} * (y - v[i] / (1.0 + exp(-abs(m)))) end")
    return f"""
nf as (select count(*) as n from emap),
nk as (select greatest(1, cast(ceil(count(*) / {Q_SHARD_ROWS}.0) as bigint)) as k from parsed_y),
dealt as (
  select sample_id, y, patientid, cast(concat('0x', substring(md5(sample_id), 1, 8)) as bigint) % (select k from nk) as shard
  from parsed_y join (select sample_id, patientid from ids) using (sample_id)),
placed as (select *, row_number() over (partition by shard order by {order}) as pos from dealt),
dense as (
  select p.shard, p.pos, any_value(p.y) as y, list(x.feature_value order by f.i) as v
  from placed p cross join (select unnest(range((select n from nf))) as i) f
  left join parsed x on x.sample_id = p.sample_id and x.feature_index = f.i
  group by p.shard, p.pos),
walk as (
  select distinct shard, cast(0 as bigint) as pos, [cast(0 as double) for i in range((select n from nf))] as w from placed
  union all
  select shard, pos, [(w[i] + {move}) * {1.0 - 2.0 * Q_ETA * Q_MU} for i in range(1, len(w) + 1)] as w
  from (select s.shard, d.pos, d.y, d.v, s.w,
               list_sum([s.w[i] * coalesce(d.v[i], 0) for i in range(1, len(s.w) + 1)]) as m
        from walk s join dense d on d.shard = s.shard and d.pos = s.pos + 1)),
ends as (select shard, w from walk qualify row_number() over (partition by shard order by pos desc) = 1),
flat as (select unnest(range(len(w))) as feature_index, unnest(w) as weight from ends)
select cast(feature_index as int) as feature_index, round(avg(weight), {DIGITS}) as weight
from flat where feature_index in (select feature_index from parsed) group by feature_index"""


DOC_SCORES = """
doc_scores as (
  select cast(l.quality as double) as y, cast(d.n_chars % 50 as double) as prob
  from labels l join documents d on l.doc_id = d.doc_id),
g as (
  select prob as score,
         sum(case when y = 1 then 1 else 0 end) as p,
         sum(case when y = 1 then 0 else 1 end) as n
  from doc_scores group by prob),
c as (
  select score, p, n,
         sum(p) over (order by score desc rows between unbounded preceding and current row) as cum_p,
         sum(n) over (order by score desc rows between unbounded preceding and current row) as cum_n,
         sum(p) over () as all_p, sum(n) over () as all_n
  from g)
"""


def _with(*blocks: str) -> str:
    return "with recursive " + ",\n".join(b.strip() for b in blocks)


# -------------------------------------------------------------- cohorts --

@register("split_alive", _with(BASE) + """
select patientid, eventid, etimestamp, value from tagged where cohort = 'alive'""")
def q_split_alive(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    return split_alive_dead(ev, mo)[0]


@register("split_dead", _with(BASE) + """
select patientid, eventid, etimestamp, value from tagged where cohort = 'dead'""")
def q_split_dead(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    return split_alive_dead(ev, mo)[1]


@register("patient_profile", _with(BASE, PROFILE) + """
select cohort, patientid, n_events, n_encounters, first_date, last_date, record_days from prof""")
def q_patient_profile(spark, sf_dir):
    return patient_profile(*cohort_inputs(spark, sf_dir))


@register("cohort_metrics", _with(BASE, PROFILE) + f"""
select cohort, round(events_avg, {DIGITS}) as events_avg, events_min, events_max,
       round(encounters_avg, {DIGITS}) as encounters_avg, encounters_median,
       encounters_min, encounters_max,
       round(days_avg, {DIGITS}) as days_avg, days_median, days_min, days_max
from summary""")
def q_cohort_metrics(spark, sf_dir):
    m = cohort_profile(*cohort_inputs(spark, sf_dir))["metrics"]
    return m.select("cohort", _r("events_avg"), "events_min", "events_max",
                    _r("encounters_avg"), "encounters_median", "encounters_min", "encounters_max",
                    _r("days_avg"), "days_median", "days_min", "days_max")


def _both(spark, sf_dir, metrics) -> DataFrame:
    """A metric function's (alive, dead) frames as one tagged table."""
    alive, dead = metrics(*split_alive_dead(*cohort_inputs(spark, sf_dir)))
    return (alive.withColumn("cohort", F.lit("alive")).unionByName(dead.withColumn("cohort", F.lit("dead")))
            .withColumn("avg", _r("avg")))


@register("event_count_metrics", _with(BASE, PROFILE) + f"""
select cohort, round(events_avg, {DIGITS}) as avg, events_min as min, events_max as max
from summary""")
def q_event_count_metrics(spark, sf_dir):
    return _both(spark, sf_dir, event_count_metrics)


@register("encounter_count_metrics", _with(BASE, PROFILE) + f"""
select cohort, round(encounters_avg, {DIGITS}) as avg, encounters_median as median,
       encounters_min as min, encounters_max as max
from summary""")
def q_encounter_count_metrics(spark, sf_dir):
    return _both(spark, sf_dir, encounter_count_metrics)


@register("record_length_metrics", _with(BASE, PROFILE) + f"""
select cohort, round(days_avg, {DIGITS}) as avg, days_median as median,
       days_min as min, days_max as max
from summary""")
def q_record_length_metrics(spark, sf_dir):
    return _both(spark, sf_dir, record_length_metrics)


@register("top_codes", _with(BASE) + """
select eventid, count(*) as count from ev group by eventid
order by count desc, eventid asc limit 5""")
def q_top_codes(spark, sf_dir):
    ev, _ = cohort_inputs(spark, sf_dir)
    return top_codes(ev, 5)


COMMON = """
counted as (
  select cohort, eventid, count(*) as code_count
  from tagged where cohort is not null group by cohort, eventid),
by_class as (
  select c.cohort, c.eventid, c.code_count, k.code_class
  from counted c join (values ('DIAG'), ('LAB'), ('DRUG')) k(code_class)
    on contains(c.eventid, k.code_class)),
ranked as (
  select *, row_number() over (partition by cohort, code_class
                               order by code_count desc, eventid asc) as rank
  from by_class)
"""


@register("common_codes", _with(BASE, COMMON) + """
select cohort, code_class, cast(rank as int) as rank, eventid, code_count
from ranked where rank <= 5""")
def q_common_codes(spark, sf_dir):
    return common_codes(*cohort_inputs(spark, sf_dir), 5)


@register("profile_common_codes", _with(BASE, COMMON) + """
select cohort, code_class, cast(rank as int) as rank, eventid, code_count
from ranked where rank <= 3""")
def q_profile_common_codes(spark, sf_dir):
    return cohort_profile(*cohort_inputs(spark, sf_dir), k=3)["common_codes"]


@register("common_codes_by_class", _with(BASE, COMMON) + """
select concat(cohort, ':', code_class) as frame, eventid, code_count as count
from ranked where rank <= 5""")
def q_common_codes_by_class(spark, sf_dir):
    """The six frames, tagged and put together."""
    frames = common_codes_by_class(*split_alive_dead(*cohort_inputs(spark, sf_dir)), k=5)
    names = [f"{cohort}:{kind}" for cohort in ("alive", "dead") for kind in ("DIAG", "LAB", "DRUG")]
    out = None
    for name, frame in zip(names, frames):
        part = frame.select(F.lit(name).alias("frame"), "eventid", F.col(frame.columns[1]).alias("count"))
        out = part if out is None else out.unionByName(part)
    return out


@register("validate_unique", _with(BASE) + """
select patientid, count(*) as n_rows from mo group by patientid having count(*) > 1""")
def q_validate_unique(spark, sf_dir):
    _, mo = cohort_inputs(spark, sf_dir)
    return validate_unique(mo, "patientid")


# --------------------------------------------------------------- ingest --

def _csv_rows(rows: DataFrame, schema, *fields: str) -> DataFrame:
    """The text lines of a headerless file, read back with its schema."""
    line = F.concat_ws(",", *(F.expr(f) for f in fields))
    return rows.select(F.from_csv(line, schema.simpleString()[len("struct<"):-1].replace(":", " ")).alias("r")).select("r.*")


@register("ingest_events", """
select case when l_linenumber = 2 then null else cast(l_orderkey as int) end as patientid,
       concat('DIAG', cast(l_partkey as varchar)) as eventid,
       case when l_partkey % 7 = 0 or l_partkey % 11 = 0 then null else cast(l_shipdate as date) end as etimestamp,
       case when l_suppkey % 5 = 0 then null else cast(l_quantity as float) end as value
from lineitem""")
def q_ingest_events(spark, sf_dir):
    """Event lines with bad ids, dates and numbers, through the reader's schema."""
    raw = _csv_rows(read_table(spark, sf_dir, "lineitem"), EVENTS_CSV_SCHEMA,
                    "case when l_linenumber = 2 then 'bad' else cast(l_orderkey as string) end",
                    "concat('DIAG', l_partkey)", "'text'",
                    "case when l_partkey % 7 = 0 then 'x' when l_partkey % 11 = 0 then '' "
                    "else cast(cast(l_shipdate as date) as string) end",
                    "case when l_suppkey % 5 = 0 then 'oops' else cast(l_quantity as string) end")
    return ingest_events(raw)


@register("ingest_mortality", """
select cast(o_custkey as int) as patientid,
       case when o_orderkey % 7 = 0 or o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as mtimestamp,
       case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then 0 else 1 end as label
from orders""")
def q_ingest_mortality(spark, sf_dir):
    raw = _csv_rows(read_table(spark, sf_dir, "orders"), MORTALITY_CSV_SCHEMA, "cast(o_custkey as string)",
                    "case when o_orderkey % 7 = 0 then 'x' when o_orderkey % 11 = 0 then '' "
                    "else cast(cast(o_orderdate as date) as string) end",
                    "case when o_orderkey % 5 = 0 then 'no' when o_orderkey % 3 = 0 then '0' else '1' end")
    return ingest_mortality(raw)


# ------------------------------------------------------------- features --

@register("index_dates", _with(BASE, FEATURES) + """
select patientid, index_date from idx""")
def q_index_dates(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    return calculate_index_dates(ev, mo)


@register("filter_events", _with(BASE, FEATURES) + """
select patientid, eventid, etimestamp, value from filtered""")
def q_filter_events(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    return filter_events(ev, calculate_index_dates(ev, mo))


@register("filter_events_subcohort", _with(BASE, FEATURES) + """
select e.patientid, e.eventid, e.etimestamp, e.value
from ev e join idx i on e.patientid = i.patientid
where i.patientid % 7 = 0 and e.etimestamp between cast(i.index_date - 200 as date) and i.index_date""")
def q_filter_events_subcohort(spark, sf_dir):
    """The windows of every seventh patient, 200 days long: most events are
    pruned before the shuffle."""
    ev, mo = cohort_inputs(spark, sf_dir)
    return filter_events(ev, calculate_index_dates(ev, mo).where("patientid % 7 = 0"), window_days=200)


def _inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(events, mortality); the events, which the index dates, the count of hot
    patients and the window join all read, are joined once."""
    ev, mo = cohort_inputs(spark, sf_dir)
    return write_once(ev, "events"), mo


def _counts(spark, sf_dir) -> DataFrame:
    """Counts per patient and code, computed once for all that follows."""
    ev, mo = _inputs(spark, sf_dir)
    return aggregate_events(filter_events(ev, calculate_index_dates(ev, mo), patients=False)).checkpoint(eager=True)


@register("aggregate_events", _with(BASE, FEATURES) + """
select patientid, eventid, feature_value from agg""")
def q_aggregate_events(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    return aggregate_events(filter_events(ev, calculate_index_dates(ev, mo)))


@register("feature_mapping", _with(BASE, FEATURES) + """
select eventid, event_index from emap""")
def q_feature_mapping(spark, sf_dir):
    ev, mo = cohort_inputs(spark, sf_dir)
    agg = aggregate_events(filter_events(ev, calculate_index_dates(ev, mo)))
    return generate_feature_mapping(agg)


@register("normalization", _with(BASE, FEATURES) + """
select patientid, eventid, normalized_feature_value from norm""")
def q_normalization(spark, sf_dir):
    return normalization(_counts(spark, sf_dir))


@register("svmlight_convert", _with(BASE, FEATURES) + """
select patientid, sparse_text from svm""")
def q_svmlight_convert(spark, sf_dir):
    return _sparse(_counts(spark, sf_dir))


def _sparse(counts: DataFrame, **options) -> DataFrame:
    svm = svmlight_convert(normalization(counts), generate_feature_mapping(counts), **options)
    return svm.select("patientid", F.array_join("sparse_feature", " ").alias("sparse_text"))


@register("svmlight_convert_pieces", _with(BASE, FEATURES) + """
select patientid, sparse_text from svm""")
def q_svmlight_convert_pieces(spark, sf_dir):
    """Rows put together from ranges of 16 codes."""
    return _sparse(_counts(spark, sf_dir), piece_codes=16)


@register("unmapped_codes", _with(BASE, FEATURES) + """
select eventid, count(*) as n_rows from norm
where normalized_feature_value > 0 and (eventid is null or eventid not in (select eventid from emap where event_index % 2 = 0))
group by eventid""")
def q_unmapped_codes(spark, sf_dir):
    """Rows per code that a map of every other code leaves out."""
    agg = _counts(spark, sf_dir)
    half = generate_feature_mapping(agg).where("event_index % 2 = 0")
    return unmapped_codes(normalization(agg), half)


def _samples(spark, sf_dir) -> DataFrame:
    return build_samples(*_inputs(spark, sf_dir), cache=False)["samples"]


@register("svmlight_samples", _with(BASE, FEATURES) + """
select patientid, save_feature from samples""")
def q_svmlight_samples(spark, sf_dir):
    return _samples(spark, sf_dir)


@register("split_test", _with(BASE, FEATURES) + f"""
select patientid, save_feature from samples where {_SPLIT_TEST}""")
def q_split_test(spark, sf_dir):
    return hash_split(_samples(spark, sf_dir), "patientid")[0]


@register("split_train", _with(BASE, FEATURES) + f"""
select patientid, save_feature from samples where not ({_SPLIT_TEST})""")
def q_split_train(spark, sf_dir):
    return hash_split(_samples(spark, sf_dir), "patientid")[1]


def _event_table(spark, sf_dir):
    """The events in 8 buckets by patient; patients of over 150 events beside them."""
    ev, mo = _inputs(spark, sf_dir)
    return write_event_table(ev, new_folder(spark, "events"), buckets=8, hot_rows=150), mo


@register("aggregate_events_colocated", _with(BASE, FEATURES) + """
select patientid, eventid, feature_value from agg""")
def q_aggregate_events_colocated(spark, sf_dir):
    return colocated_counts(*_event_table(spark, sf_dir), hot_rows=150)


@register("samples_colocated", _with(BASE, FEATURES) + """
select patientid, save_feature from samples""")
def q_samples_colocated(spark, sf_dir):
    return build_samples_colocated(*_event_table(spark, sf_dir), hot_rows=150, cache=False)["samples"]


@register("split_written", _with(BASE, FEATURES) + f"""
select case when {_SPLIT_TEST} then 'test' else 'train' end as side, save_feature from samples""")
def q_split_written(spark, sf_dir):
    """Both sides as text files, written by one job over an earlier output,
    and read back."""
    out = new_folder(spark, "split")
    paths = f"{out}/training", f"{out}/testing"
    for p in paths:
        spark.range(3).selectExpr("'old line'").write.text(p)
    train_test_split(_samples(spark, sf_dir), *paths)
    return read_split(spark, *paths)


# ---------------------------------------------------------- file sources --

# Lines with a bad id, a bad date, a bad number, a field too few and one too many.
_EVENT_LINE = """
case when l_linenumber = 2 then 'bad' else cast(l_orderkey as {text}) end || ',' || 'DIAG' || cast(l_partkey as {text}) || ',text,' ||
case when l_partkey % 7 = 0 then 'x' when l_partkey % 11 = 0 then '' else cast(cast(l_shipdate as date) as {text}) end ||
case when l_linenumber = 3 then '' else ',' || case when l_suppkey % 5 = 0 then 'oops' else cast(l_quantity as {text}) end end ||
case when l_linenumber = 4 then ',more' else '' end"""

EVENT_LINES = f"""
lines as (
  select case when l_linenumber = 2 then null else cast(l_orderkey as int) end as patientid,
         concat('DIAG', cast(l_partkey as varchar)) as eventid,
         case when l_partkey % 7 = 0 or l_partkey % 11 = 0 then null else cast(l_shipdate as date) end as etimestamp,
         case when l_suppkey % 5 = 0 or l_linenumber = 3 then null else cast(l_quantity as float) end as value,
         case when l_linenumber in (2, 3, 4) or l_partkey % 7 = 0 or l_suppkey % 5 = 0 then {_EVENT_LINE.format(text="varchar")} end as bad_record
  from lineitem)"""


def _events_file(spark, sf_dir) -> DataFrame:
    path = new_folder(spark, "events-csv")
    read_table(spark, sf_dir, "lineitem").select(F.expr(_EVENT_LINE.format(text="string")).alias("value")).write.text(path)
    return read_events_checked(spark, path)


@register("events_file", _with(EVENT_LINES) + """
select patientid, eventid, etimestamp, value, bad_record from lines""")
def q_events_file(spark, sf_dir):
    """Event files with faulty lines: the rows, and the lines that do not fit."""
    return _events_file(spark, sf_dir)


@register("events_file_report", _with(EVENT_LINES) + """
select count(*) as n_lines, count(bad_record) as n_bad_lines, count(*) - count(patientid) as n_no_patient,
       count(*) - count(etimestamp) as n_no_date from lines""")
def q_events_file_report(spark, sf_dir):
    return source_report(_events_file(spark, sf_dir))


@register("mortality_file", """
select cast(o_custkey as int) as patientid,
       case when o_orderkey % 7 = 0 or o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end as mtimestamp,
       case when o_orderkey % 5 = 0 then null when o_orderkey % 3 = 0 then 0 else 1 end as label,
       case when o_orderkey % 7 = 0 or o_orderkey % 5 = 0 then
         concat_ws(',', cast(o_custkey as varchar), case when o_orderkey % 7 = 0 then 'x' when o_orderkey % 11 = 0 then '' else cast(cast(o_orderdate as date) as varchar) end,
                   case when o_orderkey % 5 = 0 then 'no' when o_orderkey % 3 = 0 then '0' else '1' end) end as bad_record
from orders""")
def q_mortality_file(spark, sf_dir):
    path = new_folder(spark, "mortality-csv")
    line = F.expr("concat_ws(',', o_custkey, case when o_orderkey % 7 = 0 then 'x' when o_orderkey % 11 = 0 then '' "
                  "else cast(cast(o_orderdate as date) as string) end, "
                  "case when o_orderkey % 5 = 0 then 'no' when o_orderkey % 3 = 0 then '0' else '1' end)")
    read_table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return read_mortality_checked(spark, path)


# -------------------------------------------------------------- learner --

def _parsed(spark, sf_dir) -> DataFrame:
    """The parsed samples, written once: training and scoring read them."""
    return write_once(_parse(_samples(spark, sf_dir)), "parsed")


def _parse(samples: DataFrame) -> DataFrame:
    return parse_svmlight(with_sample_id(samples), "save_feature").select("sample_id", "y", "x")


@register("parse_samples", _with(BASE, FEATURES, PARSED) + """
select sample_id, y, feature_index, feature_value from parsed""")
def q_parse_samples(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.select("sample_id", "y", F.explode("x").alias("e")).select(
        "sample_id", "y", F.col("e.i").alias("feature_index"), F.col("e.v").alias("feature_value"))


ODD = """
odd as (
  select sample_id, case patientid % 5 when 0 then save_feature when 1 then concat(chr(9), save_feature, chr(9), ' ')
           when 2 then substring(save_feature, 1, 1) when 3 then concat(save_feature, ' junk x:1 2:y') else concat('x', save_feature) end as line
  from ids),
toks as (
  select sample_id, regexp_split_to_array(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '\\s+') as t from odd)
"""


@register("parse_odd_lines", _with(BASE, FEATURES, ODD) + """
select sample_id, try_cast(t[1] as double) as y, cast(len(t) - 1 as int) as n_pairs,
       cast(list_sum([case when try_cast(split_part(p, ':', 1) as int) is null then 1 else 0 end for p in t[2:]]) as bigint) as bad_index,
       cast(list_sum([case when position(':' in p) = 0 or try_cast(split_part(p, ':', 2) as double) is null then 1 else 0 end
                      for p in t[2:]]) as bigint) as bad_value
from toks""")
def q_parse_odd_lines(spark, sf_dir):
    """Lines with tabs around, a label alone, pairs without a colon or a
    number, and bad labels."""
    kind, line = F.pmod("patientid", F.lit(5)), F.col("save_feature")
    odd = (F.when(kind == 0, line).when(kind == 1, F.concat(F.lit("\t"), line, F.lit("\t "))).when(kind == 2, F.substring(line, 1, 1))
           .when(kind == 3, F.concat(line, F.lit(" junk x:1 2:y"))).otherwise(F.concat(F.lit("x"), line)))
    p = parse_svmlight(with_sample_id(_samples(spark, sf_dir)).withColumn("line", odd), "line")

    def bad(field: str):
        n = F.size(F.filter("x", lambda e: e[field].isNull())).cast("long")
        return F.when(F.size("x") > 0, n).alias(f"bad_{'index' if field == 'i' else 'value'}")

    return p.select("sample_id", "y", F.size("x").alias("n_pairs"), bad("i"), bad("v"))


ODD_LINES = """
faults as (
  select line, try_cast(t[1] as double) as y, cast(len(t) - 1 as int) as n_pairs,
         cast(coalesce(list_sum([case when try_cast(split_part(p, ':', 1) as int) is null or position(':' in p) = 0
                                        or try_cast(split_part(p, ':', 2) as double) is null then 1 else 0 end for p in t[2:]]), 0) as int) as n_bad_pairs
  from (select line, regexp_split_to_array(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '\\s+') as t from odd))
"""


def _svmlight_file(spark, sf_dir) -> DataFrame:
    """Sample files with the faults of ``parse_odd_lines``, read back."""
    path = new_folder(spark, "svmlight")
    kind, line = F.pmod("patientid", F.lit(5)), F.col("save_feature")
    odd = (F.when(kind == 0, line).when(kind == 1, F.concat(F.lit("\t"), line, F.lit("\t "))).when(kind == 2, F.substring(line, 1, 1))
           .when(kind == 3, F.concat(line, F.lit(" junk x:1 2:y"))).otherwise(F.concat(F.lit("x"), line)))
    _samples(spark, sf_dir).select(odd.alias("value")).write.text(path)
    return read_svmlight_checked(spark, path)


@register("svmlight_file", _with(BASE, FEATURES, ODD, ODD_LINES) + """
select line, y, n_pairs, n_bad_pairs, case when y is null or n_bad_pairs > 0 then line end as bad_record from faults""")
def q_svmlight_file(spark, sf_dir):
    return _svmlight_file(spark, sf_dir).select("line", "y", F.size("x").alias("n_pairs"), bad_pairs().alias("n_bad_pairs"), "bad_record")


@register("svmlight_file_report", _with(BASE, FEATURES, ODD, ODD_LINES) + """
select count(*) as n_lines, cast(sum(case when y is null or n_bad_pairs > 0 then 1 else 0 end) as bigint) as n_bad_lines,
       count(*) - count(y) as n_no_label, cast(sum(n_bad_pairs) as bigint) as n_bad_pairs from faults""")
def q_svmlight_file_report(spark, sf_dir):
    return svmlight_report(_svmlight_file(spark, sf_dir))


@register("exact_sums", """
select l_suppkey, round(fsum(l_extendedprice * (1 - l_discount) * case when l_linenumber % 2 = 0 then -1 else 1 end), 4) as total
from lineitem group by l_suppkey""")
def q_exact_sums(spark, sf_dir):
    """A balance per supplier, by sums that do not depend on the partitioning."""
    lines = read_table(spark, sf_dir, "lineitem")
    signed = F.col("l_extendedprice") * (1 - F.col("l_discount")) * F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
    sums = exact_sum(lines.select("l_suppkey", signed.cast("double").alias("price")), ["l_suppkey"], "price")
    return sums.select("l_suppkey", F.round("total", 4).alias("total"))


def _gd_weights(parsed: DataFrame, rule: str = "textbook") -> DataFrame:
    return train_gd(parsed, Q_GD_STEPS, Q_ETA, Q_MU, "sample_id", rule)


@register("train_gd_step", _with(BASE, FEATURES, GD) + f"""
select feature_index, round(weight, {DIGITS}) as weight from w2""")
def q_train_gd_step(spark, sf_dir):
    w = _gd_weights(_parsed(spark, sf_dir))
    return w.select("feature_index", _r("weight"))


@register("score", _with(BASE, FEATURES, GD, SCORED_SQL) + f"""
select sample_id, y, round(margin, {DIGITS}) as margin,
       round(1.0 / (1.0 + exp(-margin)), {DIGITS}) as prob,
       case when 1.0 / (1.0 + exp(-margin)) > 0.5 then 1 else 0 end as prediction
from scored""")
def q_score(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    scored = classify(score(parsed, _gd_weights(parsed)))
    return scored.select("sample_id", "y", _r("margin"), _r("prob"), "prediction")


@register("confusion_counts", _with(BASE, FEATURES, GD, SCORED_SQL) + f"""
, pr as (select y, 1.0 / (1.0 + exp(-margin)) as prob from scored),
cnt as (
  select sum(case when prob > 0.5 and y = 1 then 1 else 0 end) as tp,
         sum(case when prob > 0.5 and y <> 1 then 1 else 0 end) as fp,
         sum(case when prob <= 0.5 and y <> 1 then 1 else 0 end) as tn,
         sum(case when prob <= 0.5 and y = 1 then 1 else 0 end) as fn
  from pr)
select cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(tn as bigint) as tn,
       cast(fn as bigint) as fn, round((tp + tn) / (tp + fp + tn + fn), {DIGITS}) as accuracy
from cnt""")
def q_confusion_counts(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    c = confusion_counts(score(parsed, _gd_weights(parsed)))
    return c.select("tp", "fp", "tn", "fn", _r("accuracy"))


@register("train_gd_as_coded", _with(BASE, FEATURES, GD_AS_CODED) + f"""
select feature_index, round(weight, {DIGITS}) as weight from c2""")
def q_train_gd_as_coded(spark, sf_dir):
    w = _gd_weights(_parsed(spark, sf_dir), "as_coded")
    return w.select("feature_index", _r("weight"))


@register("model_auc", _with(BASE, FEATURES, SPLIT_MODEL) + f"""
select round(sum(n * (cum_p - p / 2.0)) / (sum(p) * sum(n)), {DIGITS}) as auc,
       cast(sum(p) as bigint) as n_pos, cast(sum(n) as bigint) as n_neg
from tc""")
def q_model_auc(spark, sf_dir):
    """Train on the 80 % side, score the 20 % side, AUC of the scores
    (probabilities compared at 12 decimals, so ties do not depend on the
    engine's summation order)."""
    test, train = hash_split(write_once(_samples(spark, sf_dir), "samples"), "patientid")
    p_test, w = _parse(test), _gd_weights(_parse(train))
    scored = score(p_test, w).withColumn("prob", F.round("prob", 12))
    return auc(scored).select(_r("auc"), "n_pos", "n_neg")


def _sgd(spark, sf_dir, rule: str) -> DataFrame:
    built = build_samples(*_inputs(spark, sf_dir), cache=False)
    n_feature = built["event_map"].count()          # dense index: 0..n-1
    w = train_sgd(_parse(built["samples"]), n_feature, Q_ETA, Q_MU, rule=rule, rows_per_shard=Q_SHARD_ROWS)
    return w.select("feature_index", _r("weight"))


@register("saved_model_score", _with(BASE, FEATURES, GD, SCORED_SQL) + f"""
select sample_id, y, round(margin, {DIGITS}) as margin, round(1.0 / (1.0 + exp(-margin)), {DIGITS}) as prob, 2 as version
from scored""")
def q_saved_model_score(spark, sf_dir):
    """Two versions of a model saved, a third left half-written: the second
    is loaded and scores."""
    path = new_folder(spark, "model")
    parsed = _parsed(spark, sf_dir)
    save_model(zero_weights(spark), path, Q_ETA, Q_MU, 0)
    weights = _gd_weights(parsed)
    save_model(weights, path, Q_ETA, Q_MU, weights.count())
    weights.select("feature_index", F.lit(9.0).alias("weight"), F.lit("cut off").alias("saved_by")).write.parquet(f"{path}/version=3")
    loaded, params = load_model(spark, path)
    scored = score(parsed, loaded)
    return scored.select("sample_id", "y", _r("margin"), _r("prob"), F.lit(params["version"]).alias("version"))


@register("train_sgd_ordered", _with(BASE, FEATURES, PARSED, _sgd_sql("textbook", "patientid desc, sample_id")))
def q_train_sgd_ordered(spark, sf_dir):
    """Every shard's samples in the caller's order: patients from the last to the first."""
    built = build_samples(*_inputs(spark, sf_dir), cache=False)
    data = parse_svmlight(with_sample_id(built["samples"]), "save_feature").withColumn("place", -F.col("patientid"))
    w = train_sgd(data, built["event_map"].count(), Q_ETA, Q_MU, rows_per_shard=Q_SHARD_ROWS, order_col="place")
    return w.select("feature_index", _r("weight"))


@register("train_sgd", _with(BASE, FEATURES, PARSED, _sgd_sql("textbook")))
def q_train_sgd(spark, sf_dir):
    return _sgd(spark, sf_dir, "textbook")


@register("train_sgd_as_coded", _with(BASE, FEATURES, PARSED, _sgd_sql("as_coded")))
def q_train_sgd_as_coded(spark, sf_dir):
    return _sgd(spark, sf_dir, "as_coded")


# ----------------------------------------------------------- evaluation --

def _doc_scores(spark, sf_dir) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("y"),
        (F.col("n_chars") % 50).cast("double").alias("prob"))


@register("roc_points", _with(DOC_SCORES) + f"""
select cast(score as double) as threshold, cast(cum_p as bigint) as tp, cast(cum_n as bigint) as fp,
       round(cum_p / all_p, {DIGITS}) as tpr, round(cum_n / all_n, {DIGITS}) as fpr
from c
union all
select cast(null as double), cast(0 as bigint), cast(0 as bigint),
       round(0 / max(all_p), {DIGITS}), round(0 / max(all_n), {DIGITS}) from c""")
def q_roc_points(spark, sf_dir):
    r = roc_points(_doc_scores(spark, sf_dir))
    return r.select("threshold", "tp", "fp", _r("tpr"), _r("fpr"))


@register("auc", _with(DOC_SCORES) + f"""
select round(sum(n * (cum_p - p / 2.0)) / (sum(p) * sum(n)), {DIGITS}) as auc,
       cast(sum(p) as bigint) as n_pos, cast(sum(n) as bigint) as n_neg
from c""")
def q_auc(spark, sf_dir):
    a = auc(_doc_scores(spark, sf_dir))
    return a.select(_r("auc"), "n_pos", "n_neg")


__all__ = ["queries", "oracle_sql", "register"]
