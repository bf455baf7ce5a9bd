"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain SQL over the ``fx_*`` views (inlined as CTEs). Most twins take another route than the
Spark plan (recursive reachability for components, all pairs for AUC, joins for cosines, a
finite Beta sum for ``beats_control``). The posterior grid is restated, as its
points define the result; ``beats_control`` checks it from outside. Computed doubles are
rounded the same way on both sides, last.
"""
from __future__ import annotations

from cohort.constants import CATS, FALLBACK_THRESHOLD, MATCHER_FEATURES, MAX_BLOCK, PRECISION_TARGET
from cohort.operators.logistic import DIGITS, PLACES
from cohort.operators.propensity import FEATURES as PROPENSITY
from cohort.plans.identity import FIXED_COEFFICIENTS, FIXED_THRESHOLD
from cohort.sources.fixtures import fx_cte

SQL: dict[str, str] = {}

CAP = MAX_BLOCK


def _with(fx: list[str], *ctes: str) -> str:
    parts = [fx_cte(fx)] + [c for c in ctes if c]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


GATE = """
allowed AS (select person_id from fx_persons
            where coalesce(gdpr_consent, false) and not coalesce(ccpa_opt_out, true)),
gdev AS (select * from fx_devices where person_id in (select person_id from allowed)),
gsig AS (select * from fx_signals where device_id in (select device_id from gdev)),
gev AS (select * from fx_events where device_id in (select device_id from gdev))"""

FX_ID = ["fx_persons", "fx_devices", "fx_signals", "fx_events"]


def pairs_cte(name: str, types: list[str], cap: int = CAP) -> str:
    tl = ", ".join(f"'{t}'" for t in types)
    return f"""
{name}_m AS (select distinct signal_type, signal_value, device_id from gsig
             where signal_type in ({tl}) and signal_value is not null),
{name}_ok AS (select signal_type, signal_value from {name}_m group by 1, 2 having count(*) <= {cap}),
{name}_b AS (select m.* from {name}_m m join {name}_ok using (signal_type, signal_value)),
{name} AS (select distinct a.device_id as src, b.device_id as dst
           from {name}_b a join {name}_b b
             on a.signal_type = b.signal_type and a.signal_value = b.signal_value
            and a.device_id < b.device_id)"""


DET = pairs_cte("det", ["hashed_email", "maid"])
IP = pairs_cte("ipc", ["ip"])

# Components by reachability: every node reaches itself; label = min reached id.
CC = """
det_all AS (select distinct a.device_id as src, b.device_id as dst from gsig a join gsig b
            on a.signal_type = b.signal_type and a.signal_value = b.signal_value and a.device_id < b.device_id
            where a.signal_type in ('hashed_email', 'maid')),
sym AS (select src as a, dst as b from det_all union all select dst, src from det_all),
reach(id, comp) AS (select device_id, device_id from gdev
                    union
                    select s.b, r.comp from reach r join sym s on s.a = r.id),
cc AS (select id, min(comp) as component from reach group by id)"""


def cif(cond: str) -> str:
    """count_if as BIGINT (DuckDB's count_if is HUGEINT; Spark's is bigint)."""
    return f"count_if({cond})::BIGINT"


def c2(x: str) -> str:
    return f"(({x}) * (({x}) - 1) // 2)"


SQL["contract_check"] = _with(
    FX_ID + ["fx_campaign_stream"]) + f"""
select 'campaign_stream' as "table", count(*) as rows, count(distinct round) as distinct_keys,
       {cif('round is null')} as null_key_rows,
       count(*) = count(distinct round) and {cif('round is null')} = 0 as key_unique, true as schema_ok
from fx_campaign_stream
union all
select 'devices', count(*), count(distinct device_id), {cif('device_id is null')},
       count(*) = count(distinct device_id) and {cif('device_id is null')} = 0, true from fx_devices
union all
select 'events', count(*), count(distinct event_id), {cif('event_id is null')},
       count(*) = count(distinct event_id) and {cif('event_id is null')} = 0, true from fx_events
union all
select 'interactions', count(*), count(*), 0::BIGINT, true, true
from (select distinct person_id, content_cat from fx_events join fx_devices using (device_id))
union all
select 'identity_signals', count(*),
       (select count(*) from (select distinct device_id, signal_type, signal_value from fx_signals
                              where device_id is not null and signal_type is not null and signal_value is not null)),
       {cif('device_id is null or signal_type is null or signal_value is null')},
       count(*) = (select count(*) from (select distinct device_id, signal_type, signal_value from fx_signals))
         and {cif('device_id is null or signal_type is null or signal_value is null')} = 0, true
from fx_signals
union all
select 'persons', count(*), count(distinct person_id), {cif('person_id is null')},
       count(*) = count(distinct person_id) and {cif('person_id is null')} = 0, true from fx_persons
"""

SQL["consent_flag"] = _with(["fx_persons"]) + """
select person_id, region,
       coalesce(gdpr_consent, false) and not coalesce(ccpa_opt_out, true) as processing_allowed
from fx_persons"""

SQL["pseudonymize"] = _with(["fx_devices"]) + """
select device_id,
       substr(sha1(cast(person_id as varchar)), 1, 16) as person_pid,
       substr(sha1('cohort|' || cast(person_id as varchar)), 1, 16) as person_pid_salted,
       substr(sha1('dev|' || cast(device_id as varchar)), 1, 16) as device_pid
from fx_devices"""

ALLOWED = "coalesce(gdpr_consent, false) and not coalesce(ccpa_opt_out, true)"
SQL["consent_report"] = _with(["fx_persons"]) + f"""
select count(*) as total_people,
       {cif(ALLOWED)} as allowed_people,
       round(100.0 * count_if(coalesce(gdpr_consent, false) and not coalesce(ccpa_opt_out, true))
             / greatest(1, count(*)), 2) as retained_pct,
       {cif("region = 'EU' and not coalesce(gdpr_consent, false)")} as suppressed_gdpr_no_consent,
       {cif('coalesce(ccpa_opt_out, false)')} as suppressed_ccpa_opt_out
from fx_persons"""

SQL["gate_devices"] = _with(FX_ID, GATE) + "select * from gdev"

SQL["gate_events"] = _with(FX_ID, GATE) + "select * from gev"

SQL["block_sizes"] = _with(FX_ID, GATE) + f"""
select signal_type as block_type, signal_value, count(distinct device_id) as n_devices,
       count(distinct device_id) between 2 and {CAP} as usable
from gsig where signal_type in ('hashed_email', 'maid', 'ip') and signal_value is not null
group by signal_type, signal_value"""

SQL["det_edges"] = _with(FX_ID, GATE, DET) + "select src, dst from det"

SQL["ip_candidates"] = _with(FX_ID, GATE, IP) + "select src, dst from ipc"

NEW = """
newc AS (select * from ipc where not exists (select 1 from det where det.src = ipc.src and det.dst = ipc.dst))"""

SQL["new_candidates"] = _with(FX_ID, GATE, DET, IP, NEW) + "select src, dst from newc"

SQL["edge_union"] = _with(FX_ID, GATE, DET, IP) + "select src, dst from det union select src, dst from ipc"

SQL["connected_components"] = _with(FX_ID, GATE, DET, CC) + "select id, component from cc"

PRF = f"""
truth AS (select device_id as id, person_id as person from gdev),
cells AS (select component, person, count(*) as n from cc join truth using (id) group by 1, 2),
tot AS (select (select sum({c2('n')}) from cells)::BIGINT as tp,
               (select sum({c2('n')}) from (select component, sum(n) as n from cells group by 1))::BIGINT
                 as predicted_pairs,
               (select sum({c2('n')}) from (select person, count(*) as n from truth group by 1))::BIGINT
                 as true_pairs),
prf AS (select *, case when predicted_pairs > 0 then tp / predicted_pairs else 0.0 end as p,
               case when true_pairs > 0 then tp / true_pairs else 0.0 end as r from tot)"""

SQL["pairwise_prf"] = _with(FX_ID, GATE, DET, CC, PRF) + """
select tp, predicted_pairs, true_pairs, round(p, 6) as precision, round(r, 6) as recall,
       round(case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end, 6) as f1
from prf"""

SQL["graph_counts"] = _with(FX_ID, GATE, DET, IP, NEW, CC) + """
select 'devices_in_graph' as metric, count(*) as value from gdev
union all select 'true_persons', count(distinct person_id) from gdev
union all select 'resolved_entities', count(distinct component) from cc
union all select 'deterministic_edges', count(*) from det
union all select 'candidate_pairs', count(*) from newc"""

SQL["suppressed_blocks"] = _with(FX_ID, GATE) + f"""
select signal_type as block_type, sha256(signal_value) as value_hash, count(distinct device_id) as n_devices,
       {c2('count(distinct device_id)')}::BIGINT as pairs_not_formed
from gsig where signal_type in ('hashed_email', 'maid', 'ip') and signal_value is not null
group by signal_type, signal_value having count(distinct device_id) > {CAP}"""

SQL["star_edges"] = _with(FX_ID, GATE, """
mn AS (select signal_type, signal_value, min(device_id) as src from gsig
       where signal_type in ('hashed_email', 'maid') and signal_value is not null group by 1, 2)""") + """
select distinct mn.src, g.device_id as dst from gsig g join mn using (signal_type, signal_value) where mn.src < g.device_id"""

# ----------------------------- features ---------------------------------- #

PEV = """
pev AS (select e.*, d.person_id from gev e join gdev d using (device_id)),
paff AS (select person_id, content_cat, (3 * sum(click) + count(*))::DOUBLE as w from pev group by 1, 2)"""

WIDE = "wide AS (select person_id, " + ", ".join(
    f"coalesce(sum(case when content_cat = '{c}' then w end), 0.0) as {c}" for c in CATS) + \
    " from paff group by person_id)"

UV = """
dw AS (select device_id, content_cat, (3 * sum(click) + count(*))::DOUBLE as w from gev group by 1, 2),
dn AS (select device_id, sqrt(sum(w * w)) as nrm from dw group by 1),
uv AS (select device_id, content_cat, w / nrm as u from dw join dn using (device_id))"""

FEAT = """
cosv AS (select c.src, c.dst, sum(a.u * b.u) as cosine
         from newc c join uv a on a.device_id = c.src
                     join uv b on b.device_id = c.dst and b.content_cat = a.content_cat
         group by 1, 2),
feat AS (select c.src, c.dst, coalesce(v.cosine, 0.0) as cosine,
                (ds.device_type = dd.device_type)::DOUBLE as same_type,
                (ds.person_id = dd.person_id)::DOUBLE as label
         from newc c left join cosv v on v.src = c.src and v.dst = c.dst
              join gdev ds on ds.device_id = c.src join gdev dd on dd.device_id = c.dst)"""

FIXED = f"""
acc AS (select src, dst from feat
        where 1 / (1 + exp(-({FIXED_COEFFICIENTS['intercept']} + {FIXED_COEFFICIENTS['cosine']} * round(cosine, 9)
                             + {FIXED_COEFFICIENTS['same_type']} * same_type))) >= {FIXED_THRESHOLD})"""

FULL = """
fsym AS (select a, b from sym union all select src, dst from acc union all select dst, src from acc),
freach(id, comp) AS (select device_id, device_id from gdev
                     union
                     select s.b, r.comp from freach r join fsym s on s.a = r.id),
fcc AS (select id, min(comp) as component from freach group by id)"""

SQL["resolve_identities_fixed"] = _with(FX_ID, GATE, DET, IP, NEW, CC, UV, FEAT, FIXED, FULL) + "select id, component from fcc"


def _prf_of(labels: str, variant: str) -> str:
    cells = f"(select component, person_id, count(*) as n from {labels} join gdev on device_id = id group by 1, 2)"
    return f"""
select '{variant}' as variant, tp, predicted_pairs, true_pairs, round(p, 6) as precision, round(r, 6) as recall,
       round(case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end, 6) as f1
from (select *, case when predicted_pairs > 0 then tp / predicted_pairs else 0.0 end as p,
             case when true_pairs > 0 then tp / true_pairs else 0.0 end as r
      from (select (select sum({c2('n')}) from {cells})::BIGINT as tp,
                   (select sum({c2('n')}) from (select sum(n) as n from {cells} group by component))::BIGINT as predicted_pairs,
                   (select sum({c2('n')}) from (select count(*) as n from gdev group by person_id))::BIGINT as true_pairs))"""


SQL["identity_ablation_fixed"] = (_with(FX_ID, GATE, DET, IP, NEW, CC, UV, FEAT, FIXED, FULL) + _prf_of("cc", "deterministic_only")
                                  + " union all " + _prf_of("fcc", "deterministic_plus_probabilistic"))

SQL["affinity_long"] = _with(FX_ID, GATE, PEV) + "select person_id, content_cat, w from paff"

SQL["affinity_wide"] = _with(FX_ID, GATE, PEV, WIDE) + "select * from wide"

SQL["interactions"] = _with(FX_ID, GATE, PEV) + """
select person_id, content_cat, (3 * sum(click) + count(*))::BIGINT as weight, count(*) as impressions
from pev group by 1, 2 having 3 * sum(click) + count(*) > 0"""

SQL["unit_vectors"] = _with(FX_ID, GATE, UV) + "select device_id, content_cat, round(u, 6) as u from uv"

SQL["pair_cosine"] = _with(FX_ID, GATE, DET, IP, NEW, UV, FEAT) + \
    "select src, dst, round(cosine, 6) as cosine from feat"

SQL["pair_features"] = _with(FX_ID, GATE, DET, IP, NEW, UV, FEAT) + \
    "select src, dst, round(cosine, 6) as cosine, same_type, label from feat"

SQL["standardize"] = _with(FX_ID, GATE, PEV, WIDE) + "select person_id, " + ", ".join(
    f"round(case when stddev_samp({c}) over () > 0 then ({c} - avg({c}) over ()) / stddev_samp({c}) over () "
    f"else 0.0 end, 6) as {c}" for c in CATS) + " from wide"

SQL["propensity_features"] = _with(FX_ID, GATE, PEV, WIDE) + """
select w.*, p.age, p.income_z, p.recency_days, p.converted_true::DOUBLE as label
from wide w join fx_persons p using (person_id)
where coalesce(p.gdpr_consent, false) and not coalesce(p.ccpa_opt_out, true)"""


def bucket_sql(salt: str, expr: str) -> str:
    return f"(('0x'||substr(md5(concat('{salt}|', cast({expr} as string))),1,8))::BIGINT % 100)"


SQL["hash_split"] = _with(["fx_persons"]) + f"""
select person_id, case when {bucket_sql('split', 'person_id')} < 70 then 'train' else 'test' end as split
from fx_persons"""

# ----------------------------- scores and ranking ------------------------- #

FEAT_ALL = [FX_ID, GATE, DET, IP, NEW, UV, FEAT]

SQL["precision_threshold"] = _with(*FEAT_ALL[:1], *FEAT_ALL[1:], """
sg AS (select cosine as score, count_if(label = 1)::BIGINT as pos, count_if(label <> 1)::BIGINT as neg
       from feat group by 1),
cum AS (select score, sum(pos) over (order by score desc) as cp, sum(neg) over (order by score desc) as cn
        from sg),
ok AS (select * from cum where cp / (cp + cn) >= 0.9 order by score limit 1)""") + """
select round(coalesce((select score from ok), 0.5), 6) as threshold,
       coalesce((select cp from ok), 0)::BIGINT as kept_pos, coalesce((select cn from ok), 0)::BIGINT as kept_neg,
       round((select cp / (cp + cn) from ok), 6) as precision"""

SQL["auc"] = _with(*FEAT_ALL[:1], *FEAT_ALL[1:]) + """
select count_if(label = 1)::BIGINT as positives, count_if(label <> 1)::BIGINT as negatives,
       round((select sum(case when p.cosine > n.cosine then 1.0 when p.cosine = n.cosine then 0.5 else 0.0 end)
              from feat p join feat n on p.label = 1 and n.label <> 1)
             / (count_if(label = 1) * count_if(label <> 1)), 6) as auc
from feat"""

SQL["log_loss"] = _with(*FEAT_ALL[:1], *FEAT_ALL[1:]) + """
select count(*) as n,
       round(avg(-(label * ln(least(greatest(cosine, 1e-15), 1 - 1e-15))
                   + (1 - label) * ln(1 - least(greatest(cosine, 1e-15), 1 - 1e-15)))), 6) as log_loss
from feat"""

# ----------------------------- logistic regression ------------------------ #

NEWTON_STEPS = 12


def newton_ctes(name: str, rows: str, features: list[str], steps: int = NEWTON_STEPS) -> str:
    """CTEs that fit ``label`` in ``rows``; the last, ``{name}``, holds ``b``: intercept, then coefficients.

    Each step sums gradient and Hessian and reduces the system by Gauss-Jordan in a recursive CTE.
    """
    x = ["1.0"] + [f"{f}::DOUBLE" for f in features]
    d = len(x)
    ctes = [f"{name}0 AS (select [{', '.join(['0.0::DOUBLE'] * d)}] as b)"]
    for t in range(steps):
        z = " + ".join(f"b[{i + 1}] * {c}" for i, c in enumerate(x))
        matrix = ", ".join("[" + ", ".join([f"sum(p * (1 - p) * {a} * {c})" for c in x] + [f"sum((label - p) * {a})"]) + "]"
                           for a in x)
        ctes += [
            f"{name}p{t} AS (select r.*, 1 / (1 + exp(-({z}))) as p from {rows} r, {name}{t})",
            f"{name}h{t} AS (select [{matrix}] as m from {name}p{t})",
            f"""{name}g{t}(k, m) AS (select 0, m from {name}h{t} union all
  select k + 1, list_transform(range(1, {d + 1}), lambda i: case when i = k + 1
    then list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1])
    else list_transform(range(1, {d + 2}), lambda j: m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j]) end)
  from {name}g{t} where k < {d})""",
            f"{name}{t + 1} AS (select list_transform(range(1, {d + 1}), lambda i: b[i] + m[i][{d + 1}]) as b "
            f"from {name}g{t}, {name}{t} where k = {d})"]
    stated = f"list_transform(b, lambda v: format('{{:.{DIGITS}g}}', v)::DOUBLE)"
    ctes.append(f"{name} AS (select {stated} as b from {name}{steps})")
    return ",\n".join(ctes)


def _probability(features: list[str]) -> str:
    z = " + ".join([f"b[{i + 2}] * {f}" for i, f in enumerate(features)])
    return f"round(1 / (1 + exp(-(b[1] + {z}))), {PLACES})"


MATCH = f"""
pairs AS (select src, dst, round(cosine, {PLACES}) as cosine, same_type, label,
                 case when {bucket_sql('split', "concat(src, ':', dst)")} < 70 then 'train' else 'test' end as split
          from feat),
mtrain AS (select * from pairs where split = 'train'),
""" + newton_ctes("mfit", "mtrain", MATCHER_FEATURES) + f""",
mscored AS (select src, dst, {_probability(MATCHER_FEATURES)} as p, label, split from pairs, mfit),
mgroups AS (select p, count_if(label = 1) as pos, count(*) as n from mscored where split = 'test' group by 1),
mcum AS (select p, sum(pos) over (order by p desc) / sum(n) over (order by p desc) as prec from mgroups),
mthr AS (select coalesce(min(p), {FALLBACK_THRESHOLD}) as threshold from mcum where prec >= {PRECISION_TARGET})"""

SQL["matcher_scores"] = _with(*FEAT_ALL, MATCH) + "select src, dst, p, label, split from mscored"

SQL["matcher_report"] = _with(*FEAT_ALL, MATCH) + "".join(
    f"select 'coef_{f}' as metric, b[{i + 2}] as value from mfit union all " for i, f in enumerate(MATCHER_FEATURES)) + """
select 'intercept', b[1] from mfit union all
select 'operating_threshold', threshold from mthr union all
select 'n_pairs', count(*)::DOUBLE from pairs union all
select 'auc', round((select sum(case when a.p > c.p then 1.0 when a.p = c.p then 0.5 else 0.0 end)
                     from mscored a join mscored c on a.label = 1 and c.label <> 1 and a.split = 'test' and c.split = 'test')
                    / (count_if(label = 1) * count_if(label <> 1)), 6) from mscored where split = 'test'"""

LEARNED = "acc AS (select src, dst from mscored, mthr where p >= threshold)"

SQL["resolve_identities"] = _with(FX_ID, GATE, DET, IP, NEW, CC, UV, FEAT, MATCH, LEARNED, FULL) + "select id, component from fcc"

SQL["identity_ablation"] = (_with(FX_ID, GATE, DET, IP, NEW, CC, UV, FEAT, MATCH, LEARNED, FULL) + _prf_of("cc", "deterministic_only")
                            + " union all " + _prf_of("fcc", "deterministic_plus_probabilistic"))

SQL["propensity_lr"] = _with(FX_ID, GATE, PEV, WIDE, f"""
pfeat AS (select w.*, p.age, p.income_z, p.recency_days, p.converted_true::DOUBLE as label,
                 case when {bucket_sql('split', 'w.person_id')} < 70 then 'train' else 'test' end as split
          from wide w join fx_persons p using (person_id)
          where coalesce(p.gdpr_consent, false) and not coalesce(p.ccpa_opt_out, true)),
ptrain AS (select * from pfeat where split = 'train'),
""" + newton_ctes("pfit", "ptrain", PROPENSITY)) + f"""
select person_id, 'logistic_regression' as model, {_probability(PROPENSITY)} as score, label
from pfeat, pfit where split = 'test'"""

SQL["ctr_baseline"] = _with(FX_ID, GATE, f"""
tr AS (select e.click::DOUBLE as label from gev e join gdev d using (device_id)
       where {bucket_sql('split', 'e.event_id')} < 70),
br AS (select avg(label) as p, count(*) as n from tr)""") + """
select n, round(p, 6) as base_rate,
       round(case when p <= 0 or p >= 1 then 0.0 else -(p * ln(p) + (1 - p) * ln(1 - p)) end, 6)
         as baseline_log_loss
from br"""

SQL["adjusted_rand"] = _with(FX_ID, GATE, DET, CC, f"""
truth AS (select device_id as id, person_id as person from gdev),
cells AS (select component, person, count(*) as n from cc join truth using (id) group by 1, 2),
t AS (select sum(n) as n, sum({c2('n')})::DOUBLE as s,
             (select sum({c2('n')}) from (select component, sum(n) as n from cells group by 1))::DOUBLE as a,
             (select sum({c2('n')}) from (select person, sum(n) as n from cells group by 1))::DOUBLE as b
      from cells),
e AS (select *, a * b / (n * (n - 1) / 2.0) as ex from t)""") + """
select n::BIGINT as n,
       round(case when (a + b) / 2 - ex = 0 then 1.0 else (s - ex) / ((a + b) / 2 - ex) end, 6) as ari
from e"""

ZSEG = "zs AS (select person_id, " + ", ".join(
    f"case when stddev_samp({c}) over () > 0 then ({c} - avg({c}) over ()) / stddev_samp({c}) over () "
    f"else 0.0 end as {c}" for c in CATS) + " from wide)"
MEANS = """
seg AS (select z.*, cast(p.true_segment as integer) as cluster from zs z join fx_persons p using (person_id)),
means AS (""" + " union all ".join(
    f"select cluster, '{c}' as dim, {i} as idx, avg({c}) as value from seg group by cluster"
    for i, c in enumerate(CATS)) + """),
top2 AS (select *, row_number() over (partition by cluster order by value desc, idx) as rank from means)"""

SQL["top2_per_group"] = _with(FX_ID, GATE, PEV, WIDE, ZSEG, MEANS) + """
select cluster, dim, round(value, 6) as value, rank from top2 where rank <= 2"""

SQL["segment_names"] = _with(FX_ID, GATE, PEV, WIDE, ZSEG, MEANS) + """
select k.cluster, string_agg(t.dim, ' + ' order by t.rank) || ' affinity' as label,
       (select count(*) from seg where seg.cluster = k.cluster) as size
from (select unnest(range(0, (select max(true_segment) + 1 from fx_persons)))::INTEGER as cluster) k
     left join top2 t on t.cluster = k.cluster and t.rank <= 2
group by k.cluster"""

# ----------------------------- lookalike ---------------------------------- #

LK = f"""
inter AS (select person_id, content_cat, (3 * sum(click) + count(*))::BIGINT as weight from pev group by 1, 2),
users AS (select distinct person_id from inter),
lab AS (select u.person_id, p.converted_true from users u join fx_persons p using (person_id)),
roles AS (select person_id, case when {bucket_sql('seed', 'person_id')} < 50 then 'seed' else 'heldout' end as role
          from lab where converted_true = 1),
cnt AS (select count(*) as n_all, count_if(r.role = 'seed') as n_seed
        from users u left join roles r using (person_id)),
item AS (select content_cat, sum(weight) as s_all,
                sum(case when r.role = 'seed' then weight end) as s_seed
         from inter i left join roles r using (person_id) group by 1),
up AS (select content_cat, coalesce(s_seed, 0) / (select n_seed from cnt) - s_all / (select n_all from cnt) as uplift
       from item),
chr AS (select *, row_number() over (order by uplift desc, content_cat) as rank from up qualify rank <= 2),
score AS (select u.person_id, coalesce(sum(i.weight), 0)::DOUBLE as score
          from users u left join inter i on i.person_id = u.person_id
                                         and i.content_cat in (select content_cat from chr)
          group by 1),
pool AS (select s.*, case when r.role = 'heldout' then 1 else 0 end as heldout from score s
         left join roles r using (person_id) where r.role is distinct from 'seed'),
ranked AS (select *, row_number() over (order by score desc, person_id) as rank,
                  greatest(1, floor(count(*) over () * 0.2))::BIGINT as k from pool)"""

SQL["ratings"] = _with(FX_ID, GATE, PEV, LK) + """
select person_id::INTEGER as user, (dense_rank() over (order by content_cat) - 1)::INTEGER as item, weight::FLOAT as rating
from inter where content_cat is not null"""

SQL["seed_holdout"] = _with(FX_ID, GATE, PEV, LK) + "select person_id, role from roles"

SQL["seed_overindex"] = _with(FX_ID, GATE, PEV, LK) + \
    "select content_cat, round(uplift, 6) as uplift, rank::INTEGER as rank from chr"

SQL["top_fraction"] = _with(FX_ID, GATE, PEV, LK) + \
    "select person_id, score, rank::BIGINT as rank from ranked where rank <= k"

SQL["lookalike_lift"] = _with(FX_ID, GATE, PEV, LK) + """
select count(*) as pool, count_if(rank <= k)::BIGINT as selected, round(avg(heldout), 6) as base_rate,
       round(avg(case when rank <= k then heldout end), 6) as selected_rate,
       round(avg(case when rank <= k then heldout end) / nullif(avg(heldout), 0), 6) as lift
from ranked"""

# ----------------------------- campaign ----------------------------------- #

STREAM = """
st AS (select 'fx' as test, round, batch, creative as arm, reward from fx_campaign_stream)"""


def post_cte(name: str, counts: str, group: list[str], prior: tuple[str, str] = ("1.0", "1.0")) -> str:
    return f"""
{name} AS (select *, alpha / (alpha + beta) as posterior_mean,
                 sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) as posterior_sd
          from (select *, ({prior[0]} + successes)::DOUBLE as alpha, ({prior[1]} + failures)::DOUBLE as beta
                from {counts}))"""


def grid_cte(name: str, post: str, group: list[str], arm: str = "arm") -> str:
    g = ", ".join(group)
    on = " and ".join(f"p.{c} = s.{c}" for c in group)
    return f"""
{name}_e AS (select distinct {g}, lo + k * (hi - lo) / 1024 as edge
             from (select {g}, greatest(0.0, posterior_mean - 8.0 * posterior_sd) as lo,
                          least(1.0, posterior_mean + 8.0 * posterior_sd) as hi, unnest(range(0, 1025)) as k from {post})),
{name}_w AS (select * from (select *, lead(edge) over (partition by {g} order by edge) - edge as width from {name}_e)
             where width > 0),
{name}_x AS (select p.*, s.edge, s.width, s.edge + s.width / 2 as x from {post} p join {name}_w s on {on}),
{name}_f AS (select *, exp(logf - max(logf) over (partition by {g}, {arm})) * width as fu
             from (select *, (alpha - 1) * ln(x) + (beta - 1) * ln(1 - x) as logf from {name}_x)),
{name}_c AS (select *, sum(f) over (partition by {g}, {arm} order by edge
                                    rows between unbounded preceding and current row) as cdf
             from (select *, fu / sum(fu) over (partition by {g}, {arm}) as f from {name}_f)),
{name}_l AS (select *, sum(lnF) over (partition by {g}, edge) as S
             from (select *, ln(greatest(cdf - f / 2, 1e-300)) as lnF from {name}_c)),
{name} AS (select {g}, {arm}, sum(f * exp(S - lnF)) as p_best,
                  min(case when cdf >= 0.025 and cdf - f < 0.025 then edge + width * (0.025 - (cdf - f)) / f end) as ci_low,
                  min(case when cdf >= 0.975 and cdf - f < 0.975 then edge + width * (0.975 - (cdf - f)) / f end) as ci_high,
                  count(*)::INTEGER as grid_points
           from {name}_l group by {g}, {arm})"""


COUNTS = """
cnt AS (select test, arm, count_if(reward = 1)::BIGINT as successes, count_if(reward = 0)::BIGINT as failures,
               (count_if(reward = 1) + count_if(reward = 0))::BIGINT as trials
        from st group by 1, 2)"""
CAMP = [["fx_campaign_stream"], STREAM, COUNTS, post_cte("post", "cnt", ["test"]), grid_cte("gp", "post", ["test"])]

SQL["beta_posterior"] = _with(*CAMP[:1], *CAMP[1:4]) + """
select test, arm, successes, failures, trials, alpha, beta, round(posterior_mean, 6) as posterior_mean,
       round(posterior_sd, 6) as posterior_sd from post"""

SQL["credible_interval"] = _with(*CAMP[:1], *CAMP[1:]) + """
select test, arm, round(ci_low, 6) as ci_low, round(ci_high, 6) as ci_high, grid_points from gp"""

SQL["p_best"] = _with(*CAMP[:1], *CAMP[1:]) + "select test, arm, round(p_best, 6) as p_best from gp"

SQL["ab_winner"] = _with(*CAMP[:1], *CAMP[1:]) + """
select test, arg_min(arm, (-p_best, arm)) as winner, round(max(p_best), 6) as p_best from gp group by test"""

SQL["budget_share"] = _with(*CAMP[:1], *CAMP[1:]) + "select test, arm, round(p_best, 6) as share from gp"

# Another route than the grid: the exact finite sum for two Beta posteriors with whole-number parameters,
# P(B > A) = sum_{i < alpha_B} B(alpha_A + i, beta_A + beta_B) / ((beta_B + i) B(1 + i, beta_B) B(alpha_A, beta_A)).
SQL["beats_control"] = _with(*CAMP[:1], *CAMP[1:4], """
ctl AS (select test, arg_min(arm, arm) as c, arg_min(alpha, arm) as a1, arg_min(beta, arm) as b1 from post group by test),
duel AS (select p.test, p.arm, c.a1, c.b1, p.alpha as a2, p.beta as b2, unnest(range(0, p.alpha::BIGINT)) as i
         from post p join ctl c using (test) where p.arm <> c.c)""") + """
select test, arm, round(sum(exp(lgamma(a1 + i) + lgamma(b1 + b2) - lgamma(a1 + i + b1 + b2) - ln(b2 + i)
                                - lgamma(1 + i) - lgamma(b2) + lgamma(1 + i + b2)
                                - lgamma(a1) - lgamma(b1) + lgamma(a1 + b1))), 3) as p_beats
from duel group by test, arm"""

# Success percentage per arm by which the stand-in stream draws its rewards.
SQL["winner_truth"] = _with(*CAMP[:1], *CAMP[1:]) + """
select g.test, g.winner, round(g.p_best, 6) as p_best, t.true_best, g.winner = t.true_best as correct
from (select test, arg_min(arm, (-p_best, arm)) as winner, max(p_best) as p_best from gp group by test) g
join (select arg_max(arm, r) as true_best from (
        select concat('cr_', cast(a as string)) as arm, 3 + a + case when a = 4 then 4 else 0 end as r
        from (select distinct user_id % 6 as a from events))) t on true"""

SQL["uniform_regret"] = _with(*CAMP[:1], *CAMP[1:4]) + """
select test, round(max(posterior_mean), 6) as best_rate, round(avg(posterior_mean), 6) as mean_rate,
       sum(trials)::BIGINT as n_rounds,
       round(sum(trials) * (max(posterior_mean) - avg(posterior_mean)), 6) as uniform_regret
from post group by test"""

REPLAY = """
per0 AS (select test, batch, arm, count_if(reward = 1)::BIGINT as s, count_if(reward = 0)::BIGINT as f
         from st group by 1, 2, 3),
grid AS (select a.test, a.arm, b.batch from (select distinct test, arm from per0) a
         join (select distinct test, batch from per0) b using (test)),
per AS (select g.test, g.batch, g.arm, coalesce(p.s, 0) as s, coalesce(p.f, 0) as f
        from grid g left join per0 p using (test, batch, arm)),
prior AS (select test, batch, arm, coalesce(sum(s) over w, 0) as successes,
                 coalesce(sum(f) over w, 0) as failures
          from per window w as (partition by test, arm order by batch
                                rows between unbounded preceding and 1 preceding)),""" + \
    post_cte("rpost", "prior", ["test", "batch"]) + "," + grid_cte("rg", "rpost", ["test", "batch"]) + """,
overall AS (select test, arm, sum(s) / (sum(s) + sum(f)) as rate from per group by 1, 2),
best AS (select test, arg_min(arm, (-rate, arm)) as best_arm from overall group by test),
j AS (select p.test, p.batch, p.arm, p.s + p.f as n, case when p.s + p.f > 0 then p.s / (p.s + p.f) end as bm,
             r.p_best as share, b.best_arm
      from per p join rg r using (test, batch, arm) join best b using (test)),
pb AS (select test, batch, sum(n) as n, sum(share * coalesce(bm, 0.0)) as policy_rate,
              avg(coalesce(bm, 0.0)) as uniform_rate,
              max(case when arm = best_arm then coalesce(bm, 0.0) end) as best_rate,
              max(case when arm = best_arm then share end) as best_share
       from j group by 1, 2),
pr AS (select *, n * (best_rate - policy_rate) as thompson_regret, n * (best_rate - uniform_rate) as uniform_regret
       from pb)"""

SQL["bandit_replay"] = _with(*CAMP[:1], STREAM, REPLAY) + """
select test, cast(batch as varchar) as batch, n::BIGINT as n, round(policy_rate, 6) as policy_rate, round(uniform_rate, 6) as uniform_rate,
       round(best_rate, 6) as best_rate, round(best_share, 6) as best_share,
       round(thompson_regret, 6) as thompson_regret, round(uniform_regret, 6) as uniform_regret,
       round(sum(thompson_regret) over w, 6) as cum_thompson_regret,
       round(sum(uniform_regret) over w, 6) as cum_uniform_regret,
       round(1 - case when sum(uniform_regret) over w <> 0
                      then sum(thompson_regret) over w / sum(uniform_regret) over w end, 6) as regret_reduction,
       round(sum(n * best_share) over w / sum(n) over w, 6) as cum_best_share
from pr window w as (partition by test order by batch rows between unbounded preceding and current row)"""

SQL["eb_pooling"] = _with(FX_ID, GATE, """
ec AS (select campaign as test, creative as arm, count_if(click = 1)::BIGINT as successes,
              count_if(click = 0)::BIGINT as failures, (count_if(click = 1) + count_if(click = 0))::BIGINT as trials
       from gev group by 1, 2),
mm AS (select test, avg(successes / trials) as m, var_pop(successes / trials) as v from ec where trials > 0
       group by test),
pr AS (select test, case when v > 0 and m * (1 - m) / v - 1 > 0 then m * (m * (1 - m) / v - 1) else 1.0 end
                      as prior_alpha,
              case when v > 0 and m * (1 - m) / v - 1 > 0 then (1 - m) * (m * (1 - m) / v - 1) else 1.0 end
                      as prior_beta from mm)""") + """
select test, arm, successes, failures, round(prior_alpha, 6) as prior_alpha, round(prior_beta, 6) as prior_beta,
       round((prior_alpha + successes) / (prior_alpha + prior_beta + successes + failures), 6) as posterior_mean
from ec join pr using (test)"""

SQL["stream_posterior"] = SQL["beta_posterior"]

SQL["resolved_affinity"] = _with(FX_ID, GATE, DET, CC, """
rev AS (select e.*, c.component as entity from gev e join cc c on c.id = e.device_id),
raff AS (select entity, content_cat, (3 * sum(click) + count(*))::DOUBLE as w from rev group by 1, 2)""") + \
    "select entity, " + ", ".join(
        f"coalesce(sum(case when content_cat = '{c}' then w end), 0.0) as {c}" for c in CATS) + \
    " from raff group by entity"

SQL["device_suppression"] = _with(["fx_persons", "fx_devices"]) + f"""
select count(*) as total_devices,
       {cif("p.person_id is not null and " + ALLOWED)} as kept_devices,
       {cif("p.person_id is not null and p.region = 'EU' and not coalesce(p.gdpr_consent, false)")}
         as dropped_gdpr_no_consent,
       {cif("p.person_id is not null and coalesce(p.ccpa_opt_out, false)")} as dropped_ccpa_opt_out,
       {cif("p.person_id is null")} as dropped_unknown_owner
from fx_devices d left join fx_persons p using (person_id)"""

SQL["logging_balance"] = _with(["fx_campaign_stream"], STREAM, """
pulls AS (select test, batch, arm, count(*) as pulls from st group by 1, 2, 3),
sh AS (select *, abs(pulls / sum(pulls) over (partition by test, batch)
                     - 1.0 / count(*) over (partition by test, batch)) as dev from pulls)""") + """
select test, cast(batch as varchar) as batch, sum(pulls)::BIGINT as n, count(*) as arms,
       round(max(dev), 6) as max_share_gap
from sh group by test, batch"""

SQL["stream_windowed_posterior"] = _with(["fx_campaign_stream"], """
evw AS (select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, 'fx' as test,
               concat('cr_', cast(user_id % 6 as string)) as arm,
               case when BUCKETRW < 3 + user_id % 6 + case when user_id % 6 = 4 then 4 else 0 end then 1 else 0 end
                 as reward
        from events)""".replace("BUCKETRW", bucket_sql("rw", "event_id"))) + """
select day, test, arm, count_if(reward = 1)::BIGINT as successes, count_if(reward = 0)::BIGINT as failures,
       round((1.0 + count_if(reward = 1)) / (2.0 + count(*)), 6) as posterior_mean
from evw group by day, test, arm"""
