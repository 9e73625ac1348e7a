"""SQL statements of the same queries over the same tables, for checking.

Each is written for an engine of its own and shares nothing with the operators
but the definitions of the views.
"""

from __future__ import annotations


def r(x: str, digits: int) -> str:
    """Half-up rounding spelled out, as every engine computes it the same way."""
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def money(x: str) -> str:
    return f"coalesce(cast(sum(cast({x} AS decimal(20,6))) AS double), 0e0)"


def whole(x: str) -> str:
    return f"cast(coalesce(sum({x}), 0) AS bigint)"


def div(a: str, b: str) -> str:
    return f"coalesce(cast({a} AS double) / nullif(cast({b} AS double), 0e0), 0e0)"


def guarded(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN cast({a} AS double) / {b} ELSE 0e0 END"


def f2(x: str, digits: int) -> str:
    return f"printf('%.{digits}f', {r(x, digits)})"


def vnd(x: str) -> str:
    return f"concat(format('{{:,.0f}}', cast(round_even({x}, 0) AS double)), ' ₫')"


ADS = """ads AS (
  SELECT l_orderkey * 10 + l_linenumber AS ad_id,
    concat('CAMP_', lpad(cast(l_suppkey % 12 + 1 AS varchar), 3, '0')) AS campaign_id,
    cast(l_shipdate AS date) AS date,
    CASE l_partkey % 6 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Google Ads' WHEN 2 THEN 'TikTok'
      WHEN 3 THEN 'Instagram' WHEN 4 THEN 'LinkedIn' ELSE 'Programmatic' END AS platform,
    CASE l_orderkey % 7 WHEN 0 THEN '13-17' WHEN 1 THEN '18-24' WHEN 2 THEN '25-34' WHEN 3 THEN '35-44'
      WHEN 4 THEN '45-54' WHEN 5 THEN '55-64' ELSE '65+' END AS age_group,
    cast(floor(l_extendedprice) AS bigint) AS impressions,
    cast(floor(l_extendedprice * l_discount) AS bigint) AS clicks,
    cast(floor(floor(l_extendedprice * l_discount) * l_tax) AS bigint) AS conversions,
    floor(l_extendedprice * 0.5e0) / 100 AS spend,
    floor(l_extendedprice * l_quantity * 0.02e0) / 100 AS revenue
  FROM lineitem)"""

DIRTY = """dirty AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS ad_id,
    CASE WHEN l_discount = 0.1e0 THEN NULL WHEN l_discount = 0.09e0 THEN '  '
      ELSE concat('CAMP_', lpad(cast(l_suppkey % 12 + 1 AS varchar), 3, '0')) END AS campaign_id,
    CASE WHEN l_linenumber = 6 THEN '2026-13-40' ELSE cast(cast(l_shipdate AS date) AS varchar) END AS date,
    CASE WHEN l_quantity = 1 THEN NULL ELSE CASE l_partkey % 6 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Google Ads'
      WHEN 2 THEN 'TikTok' WHEN 3 THEN 'Instagram' WHEN 4 THEN 'LinkedIn' ELSE 'Programmatic' END END AS platform,
    CASE WHEN l_quantity = 2 THEN 'unknown' ELSE CASE l_orderkey % 7 WHEN 0 THEN '13-17' WHEN 1 THEN '18-24'
      WHEN 2 THEN '25-34' WHEN 3 THEN '35-44' WHEN 4 THEN '45-54' WHEN 5 THEN '55-64' ELSE '65+' END END AS age_group,
    CASE WHEN l_tax = 0 THEN 'n/a' ELSE cast(cast(floor(l_extendedprice) AS bigint) AS varchar) END AS impressions,
    CASE WHEN l_linenumber = 5 THEN ''
      ELSE cast(cast(floor(l_extendedprice * l_discount) AS bigint) AS varchar) END AS clicks,
    CASE WHEN l_linenumber = 4 THEN NULL
      ELSE cast(cast(floor(floor(l_extendedprice * l_discount) * l_tax) AS bigint) AS varchar) END AS conversions,
    CASE WHEN l_returnflag = 'R' THEN concat('-', m)
      WHEN l_linenumber = 3 THEN concat(' ', m, ' ') ELSE m END AS spend,
    CASE WHEN l_linenumber = 2 THEN '1.5d'
      ELSE cast(cast(floor(l_extendedprice * l_quantity * 0.02e0) / 100 AS decimal(15,2)) AS varchar) END AS revenue
  FROM (SELECT *, cast(cast(floor(l_extendedprice * 0.5e0) / 100 AS decimal(15,2)) AS varchar) AS m FROM lineitem))"""

KPIS = f"""kpis AS (
  SELECT *, {guarded('clicks', 'impressions')} AS ctr, {guarded('spend', 'clicks')} AS cpc,
    {guarded('spend', 'impressions')} * 1000 AS cpm, {guarded('conversions', 'clicks')} AS cvr,
    CASE WHEN conversions > 0 THEN spend / conversions END AS cpa
  FROM ads)"""

ADDITIVE = """(CASE WHEN ctr >= 0.01e0 THEN 1 ELSE 0 END + CASE WHEN cvr >= 0.02e0 THEN 1 ELSE 0 END
    + CASE WHEN conversions > 0 AND cpa <= m THEN 1 ELSE 0 END + CASE WHEN conversions >= 1 THEN 1 ELSE 0 END)"""
ADDITIVE_LABEL = "CASE WHEN quality_score >= 3 THEN 'good' WHEN quality_score = 2 THEN 'average' ELSE 'bad' END"

MEDIAN = "med AS (SELECT coalesce(median(cpa), 0e0) AS m FROM kpis)"
SCORED = f"""scored AS (
  SELECT *, {ADDITIVE_LABEL} AS quality_label
  FROM (SELECT kpis.*, cast({ADDITIVE} AS integer) AS quality_score FROM kpis, med))"""
TIERED = """scored AS (
  SELECT *, CASE quality_score WHEN 3 THEN 'good' WHEN 2 THEN 'average' ELSE 'bad' END AS quality_label
  FROM (SELECT kpis.*, CASE WHEN ctr >= 0.01e0 AND cvr >= 0.02e0 AND cpa <= m THEN 3e0
      WHEN ctr >= 0.01e0 OR cvr >= 0.02e0 OR cpa <= m THEN 2e0 ELSE 1e0 END AS quality_score FROM kpis, med))"""

FEATURES = f"""seg AS (
  SELECT *, {guarded('total_conversions', 'total_spent')} AS conversion_per_spend,
    CASE WHEN avg_cpa > 0 THEN 1e0 / avg_cpa ELSE 0e0 END AS cpa_inverse
  FROM (SELECT campaign_id, age_group, count(*) AS ads_count, {money('spend')} AS total_spent,
      cast(sum(conversions) AS double) AS total_conversions, avg(ctr) AS avg_ctr, avg(cvr) AS avg_cvr,
      avg(cpa) AS avg_cpa, avg(CASE WHEN quality_label = 'good' THEN 1e0 ELSE 0e0 END) AS good_ratio
    FROM scored WHERE trim(campaign_id) <> '' AND age_group <> 'unknown' GROUP BY ALL))"""
FEATURE_NAMES = ["avg_ctr", "avg_cvr", "conversion_per_spend", "good_ratio", "cpa_inverse"]


def _norm(name: str, over: str = "") -> str:
    lo, hi = f"min({name}) OVER ({over})", f"max({name}) OVER ({over})"
    return f"CASE WHEN {hi} > {lo} THEN ({name} - {lo}) / ({hi} - {lo}) ELSE 0.5e0 END AS norm_{name}"


NORM = f"norm AS (SELECT *, {', '.join(_norm(n) for n in FEATURE_NAMES)} FROM seg)"
SCORE = r(
    "norm_avg_ctr * 0.2e0 + norm_avg_cvr * 0.3e0 + norm_conversion_per_spend * 0.25e0"
    " + norm_good_ratio * 0.15e0 + norm_cpa_inverse * 0.1e0",
    6,
)
ACTION = """CASE WHEN recommendation_score >= 0.7e0 THEN 'increase_budget'
    WHEN recommendation_score >= 0.45e0 THEN 'keep_and_test' ELSE 'reduce_budget' END AS suggested_action"""
ACT = f"act AS (SELECT *, {ACTION} FROM (SELECT *, {SCORE} AS recommendation_score FROM norm))"


def _recs(extra: str = "", over: str = "") -> str:
    total = f"cast(sum(cast(recommendation_score AS decimal(20,6))) OVER ({over}) AS double)"
    return f"""recs AS (
  SELECT {extra}concat(campaign_id, '|', age_group) AS segment_id, campaign_id, age_group, ads_count,
    {r('total_spent', 4)} AS total_spent, {r('total_conversions', 4)} AS total_conversions,
    {r('avg_ctr', 6)} AS avg_ctr, {r('avg_cvr', 6)} AS avg_cvr, {r('avg_cpa', 6)} AS avg_cpa,
    {r('good_ratio', 6)} AS good_ratio, {r('conversion_per_spend', 6)} AS conversion_per_spend,
    recommendation_score,
    {r(f'CASE WHEN {total} > 0 THEN recommendation_score / {total} ELSE 0e0 END', 6)} AS recommended_weight,
    suggested_action
  FROM act)"""


RECS = _recs()
EXPLAIN = f"""concat(CASE suggested_action WHEN 'increase_budget' THEN 'Tang ngan sach do hieu qua tong hop cao'
    WHEN 'reduce_budget' THEN 'Giam ngan sach do hieu qua tong hop thap'
    ELSE 'Giu ngan sach va tiep tuc A/B test' END, '; ',
    CASE WHEN avg_cpa > 0 THEN concat('avg_cpa=', {f2('avg_cpa', 2)}, ', ') ELSE '' END,
    'avg_cvr=', {f2('avg_cvr', 4)}, ', good_ratio=', {f2('good_ratio', 2)},
    ', score=', {f2('recommendation_score', 4)}) AS explanation"""

METRIC_SUMS = f"""{whole('impressions')} AS impressions, {whole('clicks')} AS clicks,
    {whole('conversions')} AS conversions, {money('spend')} AS spend, {money('revenue')} AS revenue"""
RATIOS = f"""{div('clicks', 'impressions')} * 100 AS ctr_pct, {div('conversions', 'clicks')} * 100 AS cvr_pct,
    {div('spend', 'conversions')} AS cpa, {div('revenue', 'spend')} AS roas,
    {div('revenue - spend', 'spend')} * 100 AS roi_pct"""


def performance(name: str, keys: str) -> str:
    return f"{name} AS (SELECT *, {RATIOS} FROM (SELECT {keys}, {METRIC_SUMS} FROM ads GROUP BY 1))"


PLATFORM = performance("plat", "platform")
CAMPAIGN = performance("camp", "campaign_id")
SEGMENT = performance("sgm", "concat(platform, ' | ', age_group) AS segment")
OVERALL = f"""overall AS (
  SELECT *, {div('spend', 'clicks')} AS cpc, {div('spend', 'impressions')} * 1000 AS cpm, {RATIOS}
  FROM (SELECT count(*) AS n, {METRIC_SUMS} FROM ads))"""
OVERALL_COLUMNS = """impressions AS total_impressions, clicks AS total_clicks, conversions AS total_conversions,
    spend AS total_spend, revenue AS total_revenue, ctr_pct, cvr_pct, cpa, roas, roi_pct, cpc, cpm"""
DAILY = f"""daily AS (
  SELECT date, impressions, clicks, conversions, spend, revenue, ctr_pct AS ctr, cvr_pct AS cvr, roas, roi_pct AS roi
  FROM (SELECT *, {RATIOS} FROM (SELECT date, {METRIC_SUMS} FROM ads GROUP BY 1)))"""

USERS = """users AS (
  SELECT c_custkey AS id, lower(c_name) AS username, CASE c_mktsegment WHEN 'BUILDING' THEN 'admin'
    WHEN 'MACHINERY' THEN 'analyst' WHEN 'HOUSEHOLD' THEN 'guest' ELSE 'user' END AS role,
    c_acctbal > 0 AS is_active FROM customer)"""
SESSIONS = """sessions AS (
  SELECT concat('jti-', cast(event_id AS varchar)) AS session_token, user_id, event_type AS user_agent,
    ts AS created_at, ts + interval '60' minute AS expires_at, value < 40 AS is_active FROM events)"""
_UPLOAD = """o_orderkey AS id, concat('campaigns_', lower(o_orderstatus), '_', cast(o_orderkey % 100 AS varchar), '.csv')
    AS file_name, cast(floor(o_totalprice / 100) AS int) AS scored_rows, cast(o_orderkey % 84 AS int) AS segment_rows"""
LOGS = f"""logs AS (SELECT {_UPLOAD}, o_orderdate AS uploaded_at, lower(c_name) AS uploader_name
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
DATASETS = f"""datasets AS (SELECT {_UPLOAD}, lower(c_name) AS uploaded_by, o_orderstatus = 'O' AS active,
    o_orderdate AS created_at FROM orders JOIN customer ON o_custkey = c_custkey)"""
ONLINE = "online AS (SELECT DISTINCT user_id FROM sessions WHERE is_active)"

AD = "ad_id, campaign_id, date, platform, age_group, impressions, clicks, conversions, spend, revenue"
SC = f"{AD}, ctr, cpc, cpm, cvr, cpa, quality_score, quality_label"
REC = """segment_id, campaign_id, age_group, ads_count, total_spent, total_conversions, avg_ctr, avg_cvr, avg_cpa,
    good_ratio, conversion_per_spend, recommendation_score, recommended_weight, suggested_action"""

TO_SCORED = [ADS, KPIS, MEDIAN, SCORED]
TO_RECS = [*TO_SCORED, FEATURES, NORM, ACT, RECS]


def q(ctes: list[str], body: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


def number(name: str) -> str:
    return f"try_cast({name} AS double)"


def _kpi_by(label: str, where: str = "", limit: str = "LIMIT 12") -> str:
    return q(
        TO_SCORED,
        f"""SELECT {label} AS label, {r('avg(ctr)', 6)} AS ctr, {r('avg(cvr)', 6)} AS cvr,
        cast(round(sum(cast(spend AS decimal(20,6))), 2) AS double) AS spend
        FROM scored {where} GROUP BY 1 ORDER BY spend DESC, label {limit}""",
    )


def _picked(budget: str) -> str:
    return f"""picked AS (SELECT * FROM recs ORDER BY recommendation_score DESC, segment_id LIMIT 10),
    shared AS (SELECT *, CASE WHEN sum(cast(recommended_weight AS decimal(18,6))) OVER () > 0
      THEN recommended_weight / cast(sum(cast(recommended_weight AS decimal(18,6))) OVER () AS double)
      ELSE 1e0 / count(*) OVER () END AS w FROM picked),
    alloc AS (SELECT *, {budget} * w AS a FROM shared),
    plan AS (SELECT segment_id, campaign_id, age_group, suggested_action, recommendation_score,
      {r('w', 6)} AS weight, {r('a', 2)} AS allocated_budget,
      CASE WHEN avg_cpa > 0 THEN {r('a / avg_cpa', 4)} END AS expected_conversions, {EXPLAIN} FROM alloc)"""


REALLOC = f"""m AS (SELECT *, greatest(roas, 0e0) AS roas_up, sum(spend) OVER () AS budget FROM plat),
  nrm AS (SELECT *,
    CASE WHEN max(roas_up) OVER () > min(roas_up) OVER () THEN (roas_up - min(roas_up) OVER ())
      / (max(roas_up) OVER () - min(roas_up) OVER ()) ELSE 1e0 END AS n_roas,
    CASE WHEN max(roi_pct) OVER () > min(roi_pct) OVER () THEN (roi_pct - min(roi_pct) OVER ())
      / (max(roi_pct) OVER () - min(roi_pct) OVER ()) ELSE 1e0 END AS n_roi,
    CASE WHEN max(cvr_pct) OVER () > min(cvr_pct) OVER () THEN (cvr_pct - min(cvr_pct) OVER ())
      / (max(cvr_pct) OVER () - min(cvr_pct) OVER ()) ELSE 1e0 END AS n_cvr,
    CASE WHEN max(cpa) OVER () > min(cpa) OVER () THEN (cpa - min(cpa) OVER ())
      / (max(cpa) OVER () - min(cpa) OVER ()) ELSE 1e0 END AS n_cpa FROM m),
  sc AS (SELECT *, {r('greatest(0.45e0 * n_roas + 0.35e0 * n_roi + 0.2e0 * n_cvr - 0.25e0 * n_cpa, 0e0)', 12)} AS s FROM nrm),
  rel AS (SELECT platform, spend, roas, roi_pct, cpa, cvr_pct, ctr_pct,
    CASE WHEN sum(s) OVER () = 0 THEN 1e0 ELSE s END AS score,
    CASE WHEN sum(s) OVER () = 0 THEN 1e0 / count(*) OVER ()
      ELSE s / cast(sum(cast(s AS decimal(20,12))) OVER () AS double) END AS share,
    cast(sum(cast(spend AS decimal(20,6))) OVER () AS double) AS total FROM sc),
  realloc AS (SELECT platform, spend, roas, roi_pct, cpa, cvr_pct, ctr_pct, score,
    {r('share * total', 6)} AS recommended_spend, {r('share * total - spend', 6)} AS delta FROM rel)"""


def _pick(position: int, kind: str, table: str, key: str, order: str, detail: str) -> str:
    return f"""(SELECT {position} AS position, '{kind}' AS kind, {key} AS name, {detail} AS detail
    FROM {table} ORDER BY {order}, {key} LIMIT 1)"""


_ROAS = f"concat('ROAS ', {f2('roas', 2)}, 'x')"
_ROI = f"concat('ROI ', {f2('roi_pct', 1)}, '%')"
_CPA = f"concat('CPA ', {vnd('cpa')})"
_CVR = f"concat('CVR ', {f2('cvr_pct', 2)}, '%')"
_CTR = f"concat('CTR ', {f2('ctr_pct', 2)}, '%')"
PICKS = " UNION ALL ".join(
    [
        _pick(1, "increase_platform", "plat", "platform", "roas DESC, roi_pct DESC", f"concat_ws(' | ', {_ROAS}, {_ROI}, {_CPA})"),
        _pick(2, "reduce_platform", "plat", "platform", "cpa DESC, roi_pct", f"concat_ws(' | ', {_CPA}, {_ROI}, {_CVR})"),
        _pick(3, "prioritize_segment", "sgm", "segment", "roas DESC, cvr_pct DESC", f"concat_ws(' | ', {_CVR}, {_ROAS}, {_CTR})"),
        _pick(4, "derisk_segment", "sgm", "segment", "cpa DESC, roi_pct", f"concat_ws(' | ', {_CPA}, {_ROI})"),
        _pick(5, "scale_campaign", "camp", "campaign_id", "roas DESC, conversions DESC",
              f"concat('ROAS ', {f2('roas', 2)}, 'x | Conversions ', format('{{:,}}', conversions))"),
        _pick(6, "pause_campaign", "camp", "campaign_id", "roi_pct, roas", f"concat_ws(' | ', {_ROI}, {_ROAS}, {_CPA})"),
    ]
)
INSIGHTS = f"""SELECT 1 AS position, 'dataset_scale' AS kind,
    concat('Dataset scale: ', format('{{:,}}', n), ' rows') AS message FROM overall
  UNION ALL SELECT 2, 'overall', concat('Overall CTR: ', {f2('ctr_pct', 2)}, '% | CVR: ', {f2('cvr_pct', 2)}, '%') FROM overall
  UNION ALL (SELECT 3, 'best_platform', concat('Best platform (ROAS): ', platform, ' → ', {f2('roas', 2)}, 'x')
    FROM plat ORDER BY roas DESC, platform LIMIT 1)
  UNION ALL (SELECT 4, 'cost_risk', concat('Cost risk platform (CPA): ', platform, ' → ', {vnd('cpa')})
    FROM plat ORDER BY cpa DESC, platform LIMIT 1)
  UNION ALL (SELECT 5, 'top_campaign', concat('Top campaign to scale: ', campaign_id, ' (ROAS ', {f2('roas', 2)}, 'x)')
    FROM camp ORDER BY roas DESC, conversions DESC, campaign_id LIMIT 1)
  UNION ALL SELECT 6, 'negative_roi', 'Negative ROI: prioritize budget + targeting optimization' FROM overall WHERE roi_pct < 0"""

TREND_MEANS = ", ".join(
    f"avg({m}) FILTER (n <= 7) AS {m}_c, avg({m}) FILTER (n > 7) AS {m}_p" for m in ("ctr", "cvr", "roas", "roi")
)


def _trend(m: str) -> str:
    c, p = f"{m}_c", f"{m}_p"
    change = f"(CASE WHEN {p} <> 0 THEN ({c} - {p}) / abs({p}) * 100 ELSE 0e0 END)"
    return f"""SELECT '{m}' AS metric, {r(c, 6)} AS current, {r(p, 6)} AS previous,
      CASE WHEN {c} = {p} THEN '→ Ổn định' ELSE concat(CASE WHEN {change} > 0 THEN '↑' ELSE '↓' END, ' ',
      {f2(f'abs({change})', 1)}, '%') END AS trend FROM means"""


def human(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL OR {x} = 0 THEN '0' WHEN {x} >= 1000000 THEN concat({f2(f'{x} / 1e6', 1)}, 'M')
      WHEN {x} >= 1000 THEN concat({f2(f'{x} / 1e3', 1)}, 'K') ELSE format('{{:,.2f}}', {r(x, 2)}) END"""


SUMMARY = f"""SELECT count(*) AS total_ads, cast(round(coalesce(sum(cast(spend AS decimal(20,6))), 0), 4) AS double) AS total_spent,
    {r(f"CASE WHEN {money('revenue')} = 0 AND sum(conversions) > 0 THEN sum(conversions) * 10e0 ELSE {money('revenue')} END", 2)} AS total_revenue,
    cast(sum(impressions) AS double) AS total_impressions, cast(sum(conversions) AS double) AS total_conversions,
    {r('avg(ctr)', 6)} AS avg_ctr, {r('avg(cvr)', 6)} AS avg_cvr, {r('avg(cpc)', 6)} AS avg_cpc,
    {r('avg(cpm)', 2)} AS avg_cpm, {r('coalesce(avg(cpa), 0e0)', 6)} AS avg_cpa,
    count(*) FILTER (quality_label = 'good') AS good, count(*) FILTER (quality_label = 'average') AS average,
    count(*) FILTER (quality_label = 'bad') AS bad FROM scored"""

LABEL_COUNTS = """count(*) FILTER (quality_label = 'good') AS good_count,
    count(*) FILTER (quality_label = 'average') AS average_count, count(*) FILTER (quality_label = 'bad') AS bad_count"""
MEANS = ", ".join(f"{r(f'avg({k})', 6)} AS avg_{k}" for k in ("ctr", "cpc", "cpm", "cvr", "cpa"))

BATCH = [
    ADS.replace("cast(l_shipdate AS date) AS date,", "cast(l_shipdate AS date) AS date, strftime(l_shipdate, '%Y-%m') AS batch_id,"),
    KPIS,
    "med AS (SELECT batch_id AS b, coalesce(median(cpa), 0e0) AS m FROM kpis GROUP BY 1)",
    SCORED.replace("FROM kpis, med", "FROM kpis JOIN med ON batch_id = b"),
]
BATCH_RECS = [
    *BATCH,
    FEATURES.replace("SELECT campaign_id, age_group, count", "SELECT batch_id, campaign_id, age_group, count"),
    f"norm AS (SELECT *, {', '.join(_norm(n, 'PARTITION BY batch_id') for n in FEATURE_NAMES)} FROM seg)",
    ACT,
    _recs("batch_id, ", "PARTITION BY batch_id"),
]

RULE = """SELECT count(*) FILTER (p = 1 AND y = 1) AS tp, count(*) FILTER (p = 1 AND y = 0) AS fp,
    count(*) FILTER (p = 0 AND y = 1) AS fn, count(*) FILTER (p = 0 AND y = 0) AS tn
  FROM (SELECT CASE WHEN ctr >= 0.01e0 THEN 1 ELSE 0 END AS p, CASE WHEN conversions >= 1 THEN 1 ELSE 0 END AS y FROM kpis)"""

REPAIRED = "ads AS (SELECT ad_id, campaign_id, try_cast(date AS date) AS date, platform, age_group, " + ", ".join(
    f"coalesce(try_cast({m} AS double), 0e0) AS {m}" if m in ("spend", "revenue") else f"cast(coalesce(try_cast({m} AS double), 0e0) AS bigint) AS {m}"
    for m in ("impressions", "clicks", "conversions", "spend", "revenue")
) + " FROM dirty)"

SQL: dict[str, str] = {
    # scans, repair, cleaning
    "scan_ads": q([ADS], f"SELECT {AD} FROM ads"),
    "typed_scored_ads": q(
        [DIRTY],
        f"""SELECT coalesce(cast(ad_id AS varchar), '') AS ad_id, coalesce(campaign_id, '') AS campaign_id, date,
        coalesce(platform, '') AS platform, age_group, '' AS quality_label,
        {', '.join(f'{number(m)} AS {m}' for m in ('impressions', 'clicks', 'conversions', 'spend', 'revenue'))},
        {', '.join(f'cast(NULL AS double) AS {k}' for k in ('ctr', 'cpc', 'cpm', 'cvr', 'cpa'))},
        cast(trunc(try_cast(concat(clicks, '.7') AS double)) AS bigint) AS quality_score FROM dirty""",
    ),
    "canonicalize_missing": q(
        [ADS],
        """SELECT ad_id, campaign_id, clicks, spend, '' AS date, 'unknown' AS platform, 'unknown' AS age_group,
        0e0 AS impressions, 0e0 AS conversions, 0e0 AS revenue FROM ads""",
    ),
    "coerce_numeric": q(
        [DIRTY],
        "SELECT ad_id, "
        + ", ".join(f"coalesce({number(m)}, 0e0) AS {m}" for m in ("impressions", "clicks", "conversions", "spend", "revenue"))
        + " FROM dirty",
    ),
    "coerce_clip": q(
        [DIRTY],
        "SELECT ad_id, "
        + ", ".join(f"greatest(coalesce({number(m)}, 0e0), 0e0) AS {m}" for m in ("impressions", "clicks", "conversions", "spend", "revenue"))
        + " FROM dirty",
    ),
    "convert_currency": q(
        [DIRTY],
        "SELECT ad_id, "
        + ", ".join(f"greatest(coalesce({number(m)}, 0e0) * 25000e0, 0e0) AS {m}" for m in ("spend", "revenue"))
        + " FROM dirty",
    ),
    "clean_required": q(
        [DIRTY],
        f"""SELECT {AD} FROM dirty WHERE ad_id IS NOT NULL AND campaign_id IS NOT NULL AND impressions IS NOT NULL
        AND clicks IS NOT NULL AND spend IS NOT NULL AND conversions IS NOT NULL""",
    ),
    "cleaning_report": q(
        [DIRTY],
        """SELECT count(*) AS initial_count, count(*) FILTER (ad_id IS NOT NULL AND campaign_id IS NOT NULL
        AND conversions IS NOT NULL) AS final_count, count(*) FILTER (ad_id IS NULL OR campaign_id IS NULL
        OR conversions IS NULL) AS removed_rows FROM dirty""",
    ),
    "dedupe_ads": q(
        [ADS],
        f"""SELECT {AD} FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY campaign_id, date, platform,
        age_group, impressions, clicks, conversions, spend, revenue) AS n FROM ads) WHERE n = 1""",
    ),
    "profile_dataset": q(
        [DIRTY],
        "SELECT count(*) AS row_count, "
        + ", ".join(f"count(*) - count({c}) AS missing_{c}" for c in AD.split(", "))
        + ", min(date) AS min_date, max(date) AS max_date, 10 AS column_count FROM dirty",
    ),
    "distinct_counts": q(
        [ADS],
        """SELECT count(*) AS row_count, count(DISTINCT campaign_id) AS distinct_campaign_id,
        count(DISTINCT age_group) AS distinct_age_group, count(DISTINCT platform) AS distinct_platform FROM ads""",
    ),
    "typed_load_counts": q(
        [ADS],
        """SELECT count(*) AS row_count, count(DISTINCT campaign_id) AS campaigns,
        count(DISTINCT age_group) AS age_groups, count(DISTINCT platform) AS platforms FROM ads""",
    ),
    "typed_table": q(
        [DIRTY],
        """SELECT ad_id, campaign_id, try_cast(date AS date) AS date, platform, age_group,
        cast(try_cast(impressions AS double) AS bigint) AS impressions, cast(try_cast(clicks AS double) AS bigint) AS clicks,
        cast(try_cast(conversions AS double) AS bigint) AS conversions,
        cast(cast(try_cast(spend AS double) AS decimal(15,2)) AS double) AS spend,
        cast(cast(try_cast(revenue AS double) AS decimal(15,2)) AS double) AS revenue FROM dirty""",
    ),
    "quality_contract": q(
        TO_RECS,
        """SELECT 'scored_not_empty' AS rule, cast(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bigint) AS violations FROM scored
        UNION ALL SELECT 'label_domain', count(*) FILTER (quality_label NOT IN ('good', 'average', 'bad')) FROM scored
        UNION ALL SELECT 'recommendations_not_empty', cast(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bigint) FROM recs
        UNION ALL SELECT 'action_domain', count(*) FILTER (suggested_action NOT IN
          ('increase_budget', 'keep_and_test', 'reduce_budget')) FROM recs
        UNION ALL SELECT 'weight_not_negative', count(*) FILTER (recommended_weight < 0) FROM recs""",
    ),
    "export_roundtrip": q(
        TO_RECS,
        f"SELECT format, {REC} FROM recs, (SELECT unnest(['parquet', 'csv', 'json']) AS format)",
    ),
    "stage_run_log": q(
        TO_SCORED,
        """SELECT 'data_cleaning' AS stage, 'SUCCESS' AS status, 'final_count' AS counter, count(*) AS value FROM ads
        UNION ALL SELECT 'data_cleaning', 'SUCCESS', 'initial_count', count(*) FROM ads
        UNION ALL SELECT 'data_cleaning', 'SUCCESS', 'removed_rows', cast(0 AS bigint)
        UNION ALL SELECT 'feature_engineering', 'SUCCESS', 'total_records', count(*) FROM ads
        UNION ALL SELECT 'feature_engineering', 'SUCCESS', 'with_cpa', count(cpa) FROM kpis
        UNION ALL SELECT 'aggregation', 'SUCCESS', 'campaign_count', count(DISTINCT campaign_id) FROM ads
        UNION ALL SELECT 'aggregation', 'SUCCESS', 'age_groups', count(DISTINCT age_group) FROM ads""",
    ),
    # KPIs, quality, formats
    "row_kpis": q([ADS, KPIS], f"SELECT {AD}, ctr, cpc, cpm, cvr, cpa FROM kpis"),
    "kpi_scalars": q(
        [ADS],
        f"""SELECT ad_id, {r(f"({guarded('spend', 'impressions')}) * 1000", 2)} AS cpm,
        {r(f"({guarded('(revenue - spend)', 'spend')}) * 100", 2)} AS roi, {r(guarded('revenue', 'spend'), 2)} AS roas,
        {r(guarded('spend', 'conversions'), 2)} AS cost_per_conversion FROM ads""",
    ),
    "overall_kpis": q([ADS, OVERALL], f"SELECT {OVERALL_COLUMNS} FROM overall"),
    "quality_additive": q(TO_SCORED, "SELECT ad_id, cpa, quality_score, quality_label FROM scored"),
    "quality_tiered": q([ADS, KPIS, MEDIAN, TIERED], "SELECT ad_id, cpa, quality_score, quality_label FROM scored"),
    "scored_ads": q(TO_SCORED, f"SELECT {SC} FROM scored"),
    "cpa_median": q([ADS, KPIS, MEDIAN], f"SELECT {r('m', 9)} AS cpa_median FROM med"),
    "batch_quality": q(
        BATCH,
        f"""SELECT batch_id, {r('max(m)', 9)} AS cpa_median, count(*) AS ads_count, {LABEL_COUNTS}
        FROM scored JOIN med ON batch_id = b GROUP BY 1""",
    ),
    "batch_recommendations": q(BATCH_RECS, f"SELECT batch_id, {REC} FROM recs"),
    "explain_segments": q(TO_RECS, f"SELECT segment_id, {EXPLAIN} FROM recs"),
    "explain_one_segment": q(
        TO_RECS,
        f"""SELECT segment_id, campaign_id, age_group, suggested_action, recommendation_score, {EXPLAIN}
        FROM recs WHERE segment_id = 'CAMP_003|25-34'""",
    ),
    "format_metrics": q(
        [ADS, KPIS],
        f"""SELECT ad_id, {human('impressions')} AS impressions, {human('spend')} AS spend, {human('(revenue * 1e4)')} AS revenue,
        concat({f2('ctr * 100', 2)}, '%') AS ctr, {vnd('(spend * 25000e0 + 0.5e0)')} AS amount FROM kpis""",
    ),
    "format_timestamps": q(
        [SESSIONS],
        """SELECT session_token, concat(strftime(created_at + interval '7' hour, '%Y-%m-%d %H:%M:%S'), ' +0700') AS started,
        concat(strftime(expires_at + interval '7' hour, '%Y-%m-%d %H:%M:%S'), ' +0700') AS expires FROM sessions""",
    ),
    "valid_age_band": q(
        [ADS],
        """SELECT ad_id, age_group, regexp_full_match(age_group, '[0-9]+-[0-9]+') AS valid FROM ads""",
    ),
    # filters and listings
    "filter_ads": q(
        TO_SCORED,
        f"""SELECT {SC} FROM scored WHERE campaign_id = 'CAMP_003' AND age_group = '25-34' AND quality_label = 'good'
        AND ctr >= 0.02e0 AND cpa <= 5e0""",
    ),
    "filter_segments": q(
        TO_RECS,
        f"SELECT {REC} FROM recs WHERE campaign_id = 'CAMP_003' AND suggested_action = 'reduce_budget'",
    ),
    "list_ads": q(
        TO_SCORED,
        f"""SELECT {SC}, count(*) OVER () AS total FROM scored WHERE quality_label = 'average'
        ORDER BY {AD} LIMIT 100""",
    ),
    "search_upload_logs": q(
        [LOGS],
        """SELECT *, count(*) OVER () AS total FROM logs WHERE lower(uploader_name) LIKE '%00%1%'
        AND lower(file_name) LIKE '%_o_1%' ORDER BY uploaded_at DESC, id DESC LIMIT 50""",
    ),
    "upload_logs_page": q(
        [LOGS], "SELECT *, count(*) OVER () AS total FROM logs ORDER BY uploaded_at DESC, id DESC LIMIT 50 OFFSET 100"
    ),
    "upload_logs_after": q(
        [LOGS],
        """SELECT * FROM logs WHERE (uploaded_at, id) < (timestamp '1998-01-01 00:00:00', 5000)
        ORDER BY uploaded_at DESC, id DESC LIMIT 50""",
    ),
    "list_users": q(
        [USERS],
        """SELECT *, count(*) OVER () AS total FROM users WHERE is_active AND role = 'analyst'
        AND username LIKE '%1%' ORDER BY id LIMIT 100""",
    ),
    "sessions_with_users": q(
        [USERS, SESSIONS],
        """SELECT s.*, username FROM sessions s LEFT JOIN users u ON u.id = s.user_id WHERE s.is_active""",
    ),
    "list_sessions": q(
        [USERS, SESSIONS],
        """SELECT s.*, username, count(*) OVER () AS total FROM sessions s LEFT JOIN users u ON u.id = s.user_id
        WHERE s.is_active ORDER BY created_at DESC, session_token DESC LIMIT 100 OFFSET 20""",
    ),
    "user_online_status": q(
        [USERS, SESSIONS, ONLINE],
        """SELECT users.*, CASE WHEN NOT is_active THEN 'Disabled' WHEN user_id IS NOT NULL THEN 'Online'
        ELSE 'Offline' END AS status FROM users LEFT JOIN online ON id = user_id""",
    ),
    "users_online": q([USERS, SESSIONS, ONLINE], "SELECT * FROM users WHERE is_active AND id IN (SELECT user_id FROM online)"),
    "users_offline": q(
        [USERS, SESSIONS, ONLINE], "SELECT * FROM users WHERE is_active AND id NOT IN (SELECT user_id FROM online)"
    ),
    "account_kpis": q(
        [USERS, SESSIONS, ONLINE],
        """SELECT (SELECT count(*) FROM users) AS total_users, (SELECT count(*) FROM sessions WHERE is_active) AS active_sessions,
        (SELECT count(*) FROM online JOIN users ON id = user_id) AS active_users,
        (SELECT count(*) FROM users WHERE role = 'analyst') AS analysts""",
    ),
    "last_login": q([SESSIONS], "SELECT user_id, max(coalesce(created_at, expires_at)) AS last_login FROM sessions GROUP BY 1"),
    "ads_with_action": q(
        TO_RECS,
        """SELECT ad_id, s.campaign_id, s.age_group, quality_label, recommendation_score, suggested_action
        FROM scored s JOIN recs r ON s.campaign_id = r.campaign_id AND s.age_group = r.age_group""",
    ),
    # rollups
    "campaign_aggregation": q(
        [ADS, KPIS, MEDIAN, TIERED],
        f"""SELECT campaign_id, count(ad_id) AS ad_count, {whole('impressions')} AS total_impressions,
        {whole('clicks')} AS total_clicks, {money('spend')} AS total_spend, {whole('conversions')} AS total_conversions,
        {MEANS}, {r('avg(quality_score)', 6)} AS avg_quality_score, {LABEL_COUNTS} FROM scored GROUP BY 1""",
    ),
    "age_aggregation": q(
        [ADS, KPIS], f"SELECT age_group, count(ad_id) AS ad_count, {MEANS} FROM kpis GROUP BY 1"
    ),
    "summary": q(TO_SCORED, SUMMARY),
    "summary_filtered": q(TO_SCORED, SUMMARY + " WHERE campaign_id = 'CAMP_005' AND quality_label = 'bad'"),
    "summary_no_match": """SELECT cast(0 AS bigint) AS total_ads, 0e0 AS total_spent, 0e0 AS total_revenue,
        0e0 AS total_impressions, 0e0 AS total_conversions, 0e0 AS avg_ctr, 0e0 AS avg_cvr, 0e0 AS avg_cpc, 0e0 AS avg_cpm,
        0e0 AS avg_cpa, cast(0 AS bigint) AS good, cast(0 AS bigint) AS average, cast(0 AS bigint) AS bad""",
    "advanced_summary": q(
        [ADS, KPIS],
        f"""SELECT count, {r('spend', 2)} AS total_spent, total_impressions, {r('conversions', 2)} AS total_conversions,
        {r('conversions * 10e0', 2)} AS total_revenue, avg_ctr, avg_cpc, avg_cpm, avg_cpa,
        {r('(conversions * 10e0 - spend) / spend * 100', 2)} AS avg_roi, {r('conversions * 10e0 / spend', 2)} AS avg_roas
        FROM (SELECT count(*) AS count, {money('spend')} AS spend, {whole('impressions')} AS total_impressions,
          cast(sum(conversions) AS double) AS conversions, {r('avg(ctr)', 4)} AS avg_ctr, {r('avg(cpc)', 2)} AS avg_cpc,
          {r('avg(cpm)', 2)} AS avg_cpm, {r('avg(nullif(cpa, 0))', 2)} AS avg_cpa FROM kpis)""",
    ),
    "ctr_by_platform_age": q(
        [ADS], f"SELECT platform, age_group, {div('sum(clicks)', 'sum(impressions)')} * 100 AS ctr FROM ads GROUP BY 1, 2"
    ),
    "cvr_by_age": q(
        [ADS], f"SELECT age_group, {div('sum(conversions)', 'sum(clicks)')} * 100 AS cvr, count(*) AS records FROM ads GROUP BY 1"
    ),
    "clicks_by_age": q([ADS], f"SELECT age_group, {whole('clicks')} AS clicks FROM ads GROUP BY 1"),
    "quality_distribution": q(
        TO_SCORED,
        """SELECT position, label, count(quality_label) AS value FROM (SELECT * FROM (VALUES (1, 'good'), (2, 'average'),
        (3, 'bad')) v(position, label)) LEFT JOIN scored ON quality_label = label GROUP BY 1, 2""",
    ),
    "filter_options": q(
        TO_RECS,
        """SELECT DISTINCT 'campaign_ids' AS kind, campaign_id AS value FROM scored
        UNION SELECT 'age_groups', age_group FROM scored UNION SELECT 'quality_labels', quality_label FROM scored
        UNION SELECT 'suggested_actions', suggested_action FROM recs""",
    ),
    "campaign_ranking": q(
        [ADS, CAMPAIGN], "SELECT rank() OVER (ORDER BY roi_pct DESC) AS roi_rank, campaign_id, roi_pct, roas FROM camp"
    ),
    "cpc_vs_cvr_by_campaign": q(
        [ADS, CAMPAIGN], f"SELECT campaign_id, {div('spend', 'clicks')} AS cpc, cvr_pct, conversions FROM camp"
    ),
    "risk_level": q(
        [ADS, CAMPAIGN],
        f"""SELECT {r('stddev_samp(roi_pct)', 6)} AS roi_std, CASE WHEN stddev_samp(roi_pct) > 80 THEN 'high'
        WHEN stddev_samp(roi_pct) > 40 THEN 'medium' ELSE 'low' END AS risk_level FROM camp""",
    ),
    "efficiency_score": q(
        [ADS, OVERALL],
        """SELECT cast(round_even((1 - exp(-greatest(0e0, roas) / 2e0)) * (1e0 / (1e0 + greatest(0e0, cpa) / 30e0)) * 100, 0) AS int)
        AS efficiency_score FROM overall""",
    ),
    # performance and charts
    "perf_platform": q([ADS, PLATFORM], "SELECT * FROM plat"),
    "perf_campaign": q([ADS, CAMPAIGN], "SELECT * FROM camp"),
    "perf_segment": q([ADS, SEGMENT], "SELECT * FROM sgm"),
    "roi_by_platform": q([ADS, PLATFORM], "SELECT * FROM plat ORDER BY roi_pct DESC"),
    "kpi_by_campaign": _kpi_by("campaign_id"),
    "kpi_by_platform": _kpi_by("platform", "WHERE quality_label = 'good'"),
    "kpi_by_age": _kpi_by("age_group", limit=""),
    "ctr_heatmap": q(
        [ADS],
        "SELECT age_group, "
        + ", ".join(
            f"coalesce(sum(clicks) FILTER (platform = '{p}') / nullif(cast(sum(impressions) FILTER (platform = '{p}') AS double), 0), 0e0)"
            f' * 100 AS "{p}"'
            for p in ("Facebook", "Google Ads", "TikTok", "Instagram", "LinkedIn", "Programmatic")
        )
        + " FROM ads GROUP BY 1",
    ),
    "conversion_funnel": q(
        [
            ADS,
            OVERALL,
            """fun AS (SELECT greatest(0e0, spend / (CASE WHEN cpm > 0 THEN cpm ELSE 50000e0 END) * 1000e0) AS i,
            (CASE WHEN ctr_pct > 0 THEN ctr_pct ELSE 2e0 END) / 100e0 AS c, (CASE WHEN cvr_pct > 0 THEN cvr_pct ELSE 3e0 END) / 100e0 AS v
            FROM overall)""",
        ],
        """SELECT 1 AS position, 'impressions' AS stage, cast(round_even(i, 0) AS bigint) AS volume FROM fun
        UNION ALL SELECT 2, 'clicks', cast(round_even(i * c, 0) AS bigint) FROM fun
        UNION ALL SELECT 3, 'conversions', cast(round_even(i * c * v, 0) AS bigint) FROM fun""",
    ),
    "daily_series": q([ADS, DAILY], "SELECT * FROM daily"),
    "spend_vs_revenue_daily": q([ADS, DAILY], "SELECT date, spend, revenue FROM daily"),
    "kpi_trends": q(
        [
            ADS,
            DAILY,
            f"""means AS (SELECT {TREND_MEANS}, count(*) AS days FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS n
            FROM daily) WHERE n <= 14 HAVING count(*) = 14)""",
        ],
        " UNION ALL ".join(_trend(m) for m in ("ctr", "cvr", "roas", "roi")),
    ),
    # segments and budgets
    "segment_features": q(
        [*TO_SCORED, FEATURES],
        f"""SELECT campaign_id, age_group, ads_count, total_spent, total_conversions, conversion_per_spend,
        {', '.join(f'{r(c, 6)} AS {c}' for c in ('avg_ctr', 'avg_cvr', 'avg_cpa', 'good_ratio', 'cpa_inverse'))} FROM seg""",
    ),
    "segment_normalized": q(
        [*TO_SCORED, FEATURES, NORM],
        "SELECT campaign_id, age_group, " + ", ".join(f"{r('norm_' + n, 6)} AS norm_{n}" for n in FEATURE_NAMES) + " FROM norm",
    ),
    "segment_actions": q(
        [*TO_SCORED, FEATURES, NORM, ACT], "SELECT campaign_id, age_group, recommendation_score, suggested_action FROM act"
    ),
    "budget_recommendations": q(TO_RECS, f"SELECT {REC} FROM recs"),
    "top_segments": q(
        TO_RECS,
        f"""SELECT {REC}, count(*) OVER () AS total, {EXPLAIN} FROM recs WHERE suggested_action = 'keep_and_test'
        ORDER BY recommendation_score DESC, segment_id LIMIT 20""",
    ),
    "budget_plan": q([*TO_RECS, _picked("10000e0")], "SELECT * FROM plan"),
    "budget_plan_totals": q(
        [*TO_RECS, _picked("10000e0")],
        f"""SELECT 10000e0 AS total_budget, count(*) AS segments_used,
        {r('coalesce(cast(sum(cast(expected_conversions AS decimal(20,4))) AS double), 0e0)', 4)} AS expected_total_conversions
        FROM plan""",
    ),
    "report_plan": q(
        [*TO_RECS, _picked("(SELECT cast(round(sum(cast(spend AS decimal(20,6))), 4) AS double) FROM scored)")],
        "SELECT * FROM plan",
    ),
    "platform_reallocation": q([ADS, PLATFORM, REALLOC], "SELECT * FROM realloc"),
    "reallocation_top": q([ADS, PLATFORM, REALLOC], "SELECT * FROM realloc ORDER BY delta DESC, platform LIMIT 3"),
    "optimization_picks": q([ADS, PLATFORM, CAMPAIGN, SEGMENT], PICKS),
    "insights": q([ADS, OVERALL, PLATFORM, CAMPAIGN], INSIGHTS),
    "high_roi_campaigns": q(
        [ADS],
        f"""SELECT campaign_id, {r('s', 2)} AS total_spent, {r('c', 2)} AS total_conversions,
        {r('CASE WHEN s > 0 THEN (c * 10e0 - s) / s ELSE 0e0 END * 100', 2)} AS roi,
        {r('CASE WHEN s > 0 THEN c * 10e0 / s ELSE 0e0 END', 2)} AS roas,
        {r('CASE WHEN c > 0 THEN s / c ELSE 0e0 END', 2)} AS cost_per_conversion, ad_count
        FROM (SELECT campaign_id, {money('spend')} AS s, cast(sum(conversions) AS double) AS c, count(*) AS ad_count FROM ads GROUP BY 1)
        ORDER BY roi DESC, campaign_id LIMIT 5""",
    ),
    "top_roi_campaigns": q(
        [ADS],
        f"""SELECT campaign_id, cast(r - s AS double) AS profit, {div('r - s', 's')} * 100 AS roi FROM (SELECT campaign_id,
        sum(cast(spend AS decimal(20,6))) AS s, sum(cast(revenue AS decimal(20,6))) AS r FROM ads GROUP BY 1)
        ORDER BY roi DESC, campaign_id LIMIT 5""",
    ),
    "top_campaigns_roas": q(
        [ADS, CAMPAIGN],
        "SELECT campaign_id, roas, conversions, roi_pct FROM camp ORDER BY roas DESC, conversions DESC, campaign_id LIMIT 12",
    ),
    # registry
    "active_dataset": q([DATASETS], "SELECT * FROM datasets WHERE active ORDER BY created_at DESC, id DESC LIMIT 1"),
    "dataset_history": q([DATASETS], "SELECT * FROM datasets ORDER BY created_at DESC, id DESC LIMIT 10"),
    "dataset_state": """WITH ev AS (SELECT o_custkey AS dataset_id, CASE o_orderstatus WHEN 'O' THEN 'activate' WHEN 'F' THEN 'upload'
          ELSE 'deactivate' END AS action, o_orderdate AS event_time, o_orderkey AS seq FROM orders),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY event_time DESC, seq DESC) AS n,
          row_number() OVER (ORDER BY event_time DESC, seq DESC) AS g FROM ev)
        SELECT dataset_id, action AS last_action, event_time AS last_event_time, g = 1 AND action <> 'deactivate' AS active
        FROM ranked WHERE n = 1""",
    "latest_runs": """SELECT event_type AS job, event_id AS id, CASE WHEN value < 10 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        ts AS completed_at, user_id AS row_count FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC,
        event_id DESC) AS n FROM events) WHERE n = 1""",
    "dashboard_overview": q(
        [*TO_SCORED, DATASETS],
        """SELECT (SELECT count(*) FROM scored) AS total_records, (SELECT count(*) > 0 FROM scored) AS has_data,
        (SELECT count(*) FILTER (quality_label = 'good') FROM scored) AS good,
        (SELECT id FROM datasets WHERE active ORDER BY created_at DESC, id DESC LIMIT 1) AS active_id,
        (SELECT string_agg(cast(id AS varchar), ',' ORDER BY created_at DESC, id DESC) FROM (SELECT * FROM datasets
          ORDER BY created_at DESC, id DESC LIMIT 5)) AS history_ids""",
    ),
    # models and streams
    "rule_baseline_metrics": q(
        [ADS, KPIS, f"c AS ({RULE})"],
        """SELECT cast(tp + tn AS double) / (tp + fp + fn + tn) AS accuracy, precision, recall,
        2 * precision * recall / (precision + recall) AS f1, (recall + specificity) / 2 AS roc_auc
        FROM (SELECT *, cast(tp AS double) / (tp + fp) AS precision, cast(tp AS double) / (tp + fn) AS recall,
          cast(tn AS double) / (tn + fp) AS specificity FROM c)""",
    ),
    "stream_landing_kpis": q([ADS, KPIS], f"SELECT {AD}, ctr, cpc, cpm, cvr, cpa FROM kpis"),
    "stream_daily_platform": q(
        [ADS],
        f"""SELECT date, platform, {METRIC_SUMS} FROM ads GROUP BY 1, 2""",
    ),
}

SQL |= {
    "landed_rows": SQL["scan_ads"],
    "newest_batch": SQL["scan_ads"],
    "newest_file": SQL["scan_ads"],
    "asset_freshness": "SELECT * FROM (VALUES ('lineitem', true, false), ('orders', true, false), ('no_such_table', false, true)) AS t(asset, \"exists\", no_age)",
    "latest_stage": q([ADS, KPIS], "SELECT 'READY' AS status, 'feature_engineering' AS stage, count(*) AS total_records, count(cpa) AS with_cpa FROM kpis"),
    "upload_log_after_append": q(
        [ADS],
        """SELECT f.file_name, concat('uploads/', f.file_name) AS file_path, cast(count(*) AS int) AS scored_rows,
        cast(count(DISTINCT campaign_id || age_group) AS int) AS segment_rows, 'analyst' AS uploader_role, 'ann' AS uploader_name
        FROM ads JOIN (VALUES ('all.csv', NULL), ('facebook.csv', 'Facebook')) AS f(file_name, own)
        ON f.own IS NULL OR platform = f.own GROUP BY 1""",
    ),
    "kpi_row_csv": SQL["overall_kpis"],
    "single_stages": q([ADS, KPIS], "SELECT ad_id, clicks, cpa FROM kpis"),
    "rebuild_upload": SQL["budget_recommendations"],
    "segment_report_csv": q(
        TO_RECS,
        f"""SELECT segment_id, campaign_id, age_group, suggested_action, recommendation_score, recommended_weight, avg_cpa,
        avg_cvr, good_ratio, {EXPLAIN} FROM recs""",
    ),
    "batch_quality_dirty": q(
        [
            DIRTY, REPAIRED, KPIS, "med AS (SELECT platform AS b, coalesce(median(cpa), 0e0) AS m FROM kpis GROUP BY 1)",
            SCORED.replace("FROM kpis, med", "FROM kpis JOIN med ON platform IS NOT DISTINCT FROM b"),
        ],
        f"""SELECT platform, count(*) AS ads_count, count(*) FILTER (quality_label = 'good') AS good_count,
        count(*) FILTER (quality_label = 'average') AS average_count, count(*) FILTER (quality_label = 'bad') AS bad_count,
        {r('max(m)', 9)} AS cpa_median FROM scored JOIN med ON platform IS NOT DISTINCT FROM b GROUP BY 1""",
    ),
    "small_money_totals": q([ADS], f"SELECT campaign_id, {r('sum(spend * 1e-9)', 12)} AS tiny FROM ads GROUP BY 1"),
    "ranking_with_gaps": q(
        [ADS, CAMPAIGN],
        """SELECT campaign_id, rank() OVER (ORDER BY CASE WHEN campaign_id NOT IN ('CAMP_001', 'CAMP_002') THEN roi_pct END
        DESC NULLS LAST) AS place FROM camp""",
    ),
    "platforms_dirty": q([DIRTY, REPAIRED, PLATFORM], "SELECT * FROM plat WHERE platform IS NOT NULL"),
    "daily_dirty": q([DIRTY, REPAIRED, DAILY], "SELECT * FROM daily WHERE date IS NOT NULL"),
    "segments_dirty": q(
        [DIRTY, REPAIRED, KPIS, MEDIAN, SCORED, FEATURES],
        f"""SELECT campaign_id, age_group, ads_count, total_spent, total_conversions,
        {', '.join(f'{r(c, 6)} AS {c}' for c in ('avg_ctr', 'avg_cvr', 'avg_cpa', 'good_ratio', 'cpa_inverse', 'conversion_per_spend'))} FROM seg""",
    ),
    "combined_report": f"""SELECT 'summary' AS part, 'total_ads' AS item, cast(total_ads AS double) AS value FROM ({SQL['summary']})
        UNION ALL SELECT 'summary', 'total_spent', total_spent FROM ({SQL['summary']})
        UNION ALL SELECT 'campaign_kpi', label, spend FROM ({SQL['kpi_by_campaign']})
        UNION ALL SELECT 'recommendation_count', 'segments', cast(count(*) AS double) FROM ({SQL['budget_recommendations']})
        UNION ALL SELECT 'recommendations', segment_id, recommendation_score FROM ({SQL['budget_recommendations']})
        UNION ALL SELECT 'recommendation_plan', segment_id, allocated_budget FROM ({SQL['report_plan']})""",
    "cpa_median_approx_check": "SELECT true AS within_error",
    "classifier_train_summary": q([ADS], "SELECT 'trained' AS status, count(*) AS records_used, cast(NULL AS double) AS r2_score FROM ads"),
    "predictor_residuals_check": """SELECT feature, true AS orthogonal FROM (SELECT unnest(['one', 'impressions', 'clicks', 'spend', 'ctr', 'cpc']) AS feature)""",
    "classifier_check": q([ADS], "SELECT count(*) AS row_count, cast(0 AS bigint) AS odd_rows FROM ads"),
}
