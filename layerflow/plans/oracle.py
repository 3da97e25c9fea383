"""DuckDB SQL computing each registered query's answer straight from the
driver's tables (views ``orders``, ``lineitem``, ...). Column names equal
the Spark output; types are cast to the Spark types where DuckDB differs.
"""

from __future__ import annotations

from layerflow.plans import catalog as C
from layerflow.plans import reviews as R

# RE2 knows ASCII spaces only: the Unicode ones, spelled out.
SP = r"[\s\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS = rf"'^{SP}+|{SP}+$'"


def _strip(e: str) -> str:
    return f"regexp_replace({e}, {WS}, '', 'g')"


def sql_floor(x: str) -> str:
    """F3 without lookahead (RE2)."""
    v0 = _strip(x)
    v1 = f"replace(regexp_replace(replace({v0}, '°', 'º'), '{SP}+º', 'º', 'g'), 'ª', 'º')"
    rc = f"regexp_replace(regexp_replace({v1}, '^[Rr]/[Cc]', 'R/C'), '^[Rr][Cc]([^-]|$)', 'R/C\\1')"
    piso = f"regexp_extract({rc}, '(?i)^piso{SP}+\\d+{SP}*[-–]{SP}*(.+)$', 1)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {v0} = '.' THEN NULL "
            f"WHEN {v1} IN ('0', '0º', 'Piso 0') THEN 'R/C' "
            f"WHEN regexp_matches({v1}, '^\\d+$') THEN {v1} || 'º' "
            f"WHEN {piso} <> '' THEN {_strip(piso)} ELSE {rc} END)")


def sql_postcode(code: str, zone: str) -> tuple[str, str]:
    st = _strip(code)
    pat = rf"'^{SP}*(\d{{4}}){SP}*-{SP}*(\d{{3}}){SP}*$'"
    g1, g2 = f"regexp_extract({st}, {pat}, 1)", f"regexp_extract({st}, {pat}, 2)"
    full = f"coalesce({g1} <> '', false)"
    empty = f"({zone} IS NULL OR {_strip(zone)} = '' OR lower({_strip(zone)}) = 'nan')"
    code1 = f"(CASE WHEN {full} THEN {g1} ELSE {code} END)"
    suf1 = f"(CASE WHEN {full} AND {empty} THEN {g2} ELSE {zone} END)"
    pre = f"nullif(regexp_extract({code1}, '(\\d{{4}})', 1), '')"
    suf = f"nullif(regexp_extract({suf1}, '(\\d{{3}})', 1), '')"
    zero = f"coalesce({pre} = '0000' AND {suf} = '000', false)"
    return f"(CASE WHEN {zero} THEN NULL ELSE {pre} END)", f"(CASE WHEN {zero} THEN NULL ELSE {suf} END)"


def sql_gps(g: str) -> tuple[str, str]:
    pat = rf"'^{SP}*([-\d.]+){SP}*,{SP}*([-\d.]+){SP}*$'"
    return (f"TRY_CAST(nullif(regexp_extract({g}, {pat}, 1), '') AS DOUBLE)",
            f"TRY_CAST(nullif(regexp_extract({g}, {pat}, 2), '') AS DOUBLE)")


def _case_list(idx: str, values: list) -> str:
    parts = " ".join(f"WHEN {i} THEN {'NULL' if v is None else f"'{v}'"}" for i, v in enumerate(values))
    return f"(CASE {idx} {parts} END)"


_CHANNEL = "(CASE o.o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in R.CHANNELS) + \
    " ELSE 'OTHER' END)"

# ---- review model CTEs ------------------------------------------------------------
REV = f"""
li_agg AS (SELECT l_orderkey, max(l_shipdate) AS max_ship FROM lineitem GROUP BY l_orderkey),
rv AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS review_id,
         substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 24) AS mongo_id,
         o.o_custkey + {R.EXTERNAL_ID_OFFSET} AS external_property_id,
         o.o_orderkey AS booking_id,
         strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_txt,
         'Guest ' || CAST(o.o_custkey AS VARCHAR) AS customer_name,
         strftime(o.o_orderdate, '%Y-%m-%d') AS arrival_txt,
         strftime(li_agg.max_ship, '%Y-%m-%d') AS departure_txt,
         CAST(o.o_orderkey % 101 AS DOUBLE) / 10.0 AS overall_score,
         ['en', 'pt', 'es', 'fr'][o.o_custkey % 4 + 1] AS language,
         {_CHANNEL} AS sales_channel_code,
         o.o_orderstatus = 'F' AS validated,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'Thank you' END AS response_text,
         CASE WHEN o.o_orderkey % 3 = 0 THEN strftime(CAST(o.o_orderdate AS DATE) + 2, '%Y-%m-%d') END AS response_txt,
         CASE WHEN o.o_orderkey % 2 = 0 THEN 'Great stay' ELSE ' ' END AS positive_comment,
         CASE WHEN o.o_orderkey % 5 = 0 THEN 'Noisy' END AS negative_comment,
         'ok' AS neutral_comment,
         o.o_orderstatus AS review_title,
         CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_orderkey % 7 END AS likes_count
  FROM orders o LEFT JOIN li_agg ON li_agg.l_orderkey = o.o_orderkey),
rel_reviews AS (
  SELECT review_id, mongo_id, external_property_id, CAST(arrival_txt AS DATE) AS arrival_date, booking_id,
         CAST(created_txt AS TIMESTAMP) AS created_at, customer_name, CAST(departure_txt AS DATE) AS departure_date,
         overall_score, language, negative_comment, positive_comment, response_text,
         CAST(response_txt AS DATE) AS response_date, sales_channel_code, review_title,
         CAST(validated AS INTEGER) AS is_validated
  FROM rv),
asp0 AS (SELECT l_orderkey, l_returnflag AS f, l_quantity AS q, min(l_linenumber) AS n0
         FROM lineitem GROUP BY l_orderkey, l_returnflag, l_quantity),
asp1 AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n0, f, q) - 1 AS pos FROM asp0),
asp AS (SELECT row_number() OVER (ORDER BY CAST(l_orderkey AS VARCHAR), pos) AS id,
               CAST(l_orderkey AS VARCHAR) AS parent_id, f, q / 5 AS score, pos,
               '{{"evaluationAspect":{{"type":"' || f || '"}},"valoration":' ||
               CASE WHEN CAST(q AS BIGINT) % 5 = 0 THEN CAST(CAST(q AS BIGINT) // 5 AS VARCHAR)
                    ELSE CAST(CAST(q AS BIGINT) // 5 AS VARCHAR) || '.' || CAST(CAST(q AS BIGINT) % 5 * 2 AS VARCHAR) END || '}}' AS item
        FROM asp1),
lists AS (SELECT parent_id, md5('[' || string_agg(item, ',' ORDER BY pos) || ']') AS hash_evaluationaspects FROM asp GROUP BY parent_id)
"""

_K = "c.c_custkey"
_P4 = f"lpad(CAST({_K} % 10000 AS VARCHAR), 4, '0')"
_S3 = f"lpad(CAST({_K} % 1000 AS VARCHAR), 3, '0')"
_CODE = (f"(CASE WHEN {_K} % 5 = 0 THEN {_P4} || '-' || {_S3} WHEN {_K} % 5 = 1 THEN {_P4} "
         f"WHEN {_K} % 5 = 2 THEN chr(160) || {_P4} || ' -' || chr(160) || {_S3} || ' ' WHEN {_K} % 5 = 3 THEN '0000-000' END)")
_ZONE = f"(CASE WHEN {_K} % 3 = 1 THEN {_S3} WHEN {_K} % 3 = 2 THEN 'nan' END)"
_GPS = (f"(CASE WHEN {_K} % 6 = 5 THEN '38.1.2, -9.' || CAST({_K} % 10 AS VARCHAR) "
        f"ELSE '38.' || CAST({_K} % 100 AS VARCHAR) || ', -9.' || CAST({_K} % 1000 AS VARCHAR) END)")


def _flag(m: int) -> str:
    return f"(CASE WHEN {_K} % {m} = 0 THEN '1' ELSE '0' END)"


def props(gaps: bool = True) -> str:
    """The property and mapping layers, with the gaps of the model or whole."""
    has = f"c.c_custkey % {R.PROPERTY_GAP_MOD} <> {R.PROPERTY_GAP_REM}" if gaps else "true"
    mapped = f"c_custkey % {R.MAPPING_GAP_MOD} <> {R.MAPPING_GAP_REM}" if gaps else "true"
    return f"""
praw AS (
  SELECT c.c_custkey AS k, CAST({_K} AS VARCHAR) AS id, c.c_mktsegment AS team,
         'Zone ' || CAST(c.c_nationkey AS VARCHAR) AS neighbourhood,
         {_CODE} AS code, {_ZONE} AS zone, {_GPS} AS gps,
         CASE WHEN {_K} % 11 = 0 THEN NULL ELSE {_flag(7)} END AS inativo,
         '2020-01-' || lpad(CAST({_K} % 28 + 1 AS VARCHAR), 2, '0') AS data_inicio,
         CASE WHEN {_K} % 7 = 0 THEN '2023-06-30' WHEN {_K} % 13 = 0 THEN '2022-01-01' END AS data_inativo,
         {_case_list(f"{_K} % {len(R.FLOORS)}", R.FLOORS)} AS andar,
         {_flag(2)} AS elevador,
         CASE WHEN {_K} % 17 = 0 THEN '3.0' ELSE CAST({_K} % 8 + 1 AS VARCHAR) END AS occ,
         CAST(c.c_nationkey % 3 AS VARCHAR) AS duche,
         CASE WHEN {_K} % 9 = 0 THEN 'x' ELSE '1' END AS basico,
         CASE WHEN {_K} % 4 = 0 THEN 'Garage ' || CAST({_K} AS VARCHAR) END AS garage_info,
         {_flag(2)} AS maqroupa, CASE WHEN {_K} % 3 = 0 THEN '1' END AS maqloica, '1' AS arcond,
         {_flag(5)} AS autocheckin
  FROM customer c WHERE {has}),
pclean AS (
  SELECT *, {sql_postcode('code', 'zone')[0]} AS postcode_prefix, {sql_postcode('code', 'zone')[1]} AS postcode_suffix,
         {sql_floor('andar')} AS floor
  FROM praw),
rel_props AS (
  SELECT CAST(k AS BIGINT) AS property_id, team, neighbourhood,
         TRY_CAST(postcode_prefix AS INTEGER) AS postcode_prefix, TRY_CAST(postcode_suffix AS INTEGER) AS postcode_suffix,
         CAST(coalesce(TRY_CAST(inativo AS INTEGER), 0) AS TINYINT) AS is_inactive,
         TRY_CAST(data_inicio AS TIMESTAMP) AS start_date, TRY_CAST(data_inativo AS TIMESTAMP) AS inactive_date,
         floor, TRY_CAST(elevador AS INTEGER) AS has_elevator,
         TRY_CAST(TRY_CAST(occ AS DOUBLE) AS INTEGER) AS max_occupancy,
         TRY_CAST(duche AS INTEGER) AS num_bathrooms_with_shower, TRY_CAST(basico AS INTEGER) AS num_basic_bathrooms,
         garage_info,
         CAST(coalesce(TRY_CAST(maqroupa AS INTEGER), 0) AS TINYINT) AS has_washing_machine,
         CAST(coalesce(TRY_CAST(maqloica AS INTEGER), 0) AS TINYINT) AS has_dishwasher,
         CAST(coalesce(TRY_CAST(arcond AS INTEGER), 0) AS TINYINT) AS has_air_conditioning,
         CAST(coalesce(TRY_CAST(autocheckin AS INTEGER), 0) AS TINYINT) AS has_self_checkin,
         {sql_gps('gps')[0]} AS latitude, {sql_gps('gps')[1]} AS longitude
  FROM pclean),
rel_map AS (
  SELECT CAST(c_custkey AS BIGINT) AS property_id, c_custkey + {R.EXTERNAL_ID_OFFSET} AS external_property_id
  FROM customer WHERE {mapped})
"""


PROPS = props()

STAR = """
dim_property AS (
  SELECT row_number() OVER (ORDER BY p.property_id) AS property_key, p.property_id, m.external_property_id,
         p.team, p.neighbourhood, p.postcode_prefix, p.postcode_suffix, p.floor, p.max_occupancy,
         {labels},
         CASE WHEN p.is_inactive = 1 THEN 'Inactive' ELSE 'Active' END AS status
  FROM rel_props p LEFT JOIN rel_map m ON m.property_id = p.property_id),
dim_channel AS (
  SELECT row_number() OVER (ORDER BY sales_channel_code) AS channel_key, sales_channel_code,
         CASE sales_channel_code {channel_labels} ELSE 'Other' END AS label
  FROM (SELECT DISTINCT sales_channel_code FROM rel_reviews WHERE sales_channel_code IS NOT NULL)),
dim_aspect AS (
  SELECT row_number() OVER (ORDER BY aspect) AS aspect_key, aspect,
         upper(substr(replace(aspect, '_', ' '), 1, 1)) || lower(substr(replace(aspect, '_', ' '), 2)) AS label
  FROM (SELECT DISTINCT f AS aspect FROM asp WHERE f IS NOT NULL)),
fact_reviews AS (
  SELECT r.review_id,
         CAST(strftime(r.arrival_date, '%Y%m%d') AS INTEGER) AS arrival_date_key,
         CAST(strftime(r.departure_date, '%Y%m%d') AS INTEGER) AS departure_date_key,
         CAST(strftime(r.created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
         coalesce(dp.property_key, -1) AS property_key, coalesce(dc.channel_key, -1) AS channel_key,
         r.overall_score, CAST(datediff('day', r.arrival_date, r.departure_date) AS INTEGER) AS stay_nights,
         coalesce(length(trim(r.response_text)) > 0, false) AS has_response,
         coalesce(length(trim(r.positive_comment)) > 0, false) AS has_positive_comment,
         coalesce(length(trim(r.negative_comment)) > 0, false) AS has_negative_comment
  FROM rel_reviews r
  LEFT JOIN rel_map m ON m.external_property_id = r.external_property_id
  LEFT JOIN dim_property dp ON dp.property_id = m.property_id
  LEFT JOIN dim_channel dc ON dc.sales_channel_code = r.sales_channel_code)
""".format(
    labels=", ".join(f"CASE WHEN p.{c} = 1 THEN 'Yes' WHEN p.{c} = 0 THEN 'No' ELSE 'Unknown' END AS {c}_label"
                     for c in ("has_elevator", "has_washing_machine", "has_dishwasher", "has_air_conditioning",
                               "has_self_checkin")),
    channel_labels=" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in
                            [("AIRBNB", "Airbnb"), ("BOOKING", "Booking.com"), ("HOMEAWAY", "HomeAway/VRBO"),
                             ("DIRECT", "Direct")]))

MODEL = f"WITH {REV}, {PROPS}, {STAR}"
WHOLE = f"WITH {REV}, {props(gaps=False)}, {STAR}"


def _q(body: str) -> str:
    return f"{MODEL} {body}"


def _whole(body: str) -> str:
    """Over every customer, without the model's gaps."""
    return f"{WHOLE} {body}"


#: The 44 checks, written out apart from the code under test: family, layer,
#: table, column, severity, title, and the SQL of the observed value and of
#: passing, over the CTEs {layer}_{table} (columns as in the layers).
_RV, _RA, _PR = "reviews", "review_aspects", "properties"


def _count(cte: str, cond: str = "true") -> str:
    return f"(SELECT count(*) FILTER (WHERE {cond}) FROM {cte})"


def _checks() -> list[tuple]:
    out: list[tuple] = []

    def add(fam, layer, table, column, sev, rule, observed, passes, null_status=None):
        title = f"{layer}.{table}" + (f".{column}" if column else "") + f": {rule}"
        out.append((fam, layer, table, column, sev, title, observed, passes, null_status))

    for t in (_RV, _RA, _PR):
        add("V1", "raw/clean", t, None, "FAIL", "equal row counts", f"{_count('raw_' + t)} - {_count('clean_' + t)}", "= 0")
        add("V1", "clean/rel", t, None, "FAIL", "equal row counts", f"{_count('clean_' + t)} - {_count('rel_' + t)}", "= 0")
    for layer, t, shown, n in (("raw", _RV, _RV, 100), ("clean", _RV, _RV, 100), ("rel", _RV, _RV, 100),
                               ("raw", _RA, "reviews_evaluationaspects", 100), ("clean", _RA, _RA, 100),
                               ("raw", _PR, "propriedades", 10), ("clean", _PR, _PR, 10)):
        add("V2", layer, shown, None, "FAIL", f"at least {n} rows", _count(f"{layer}_{t}"), f">= {n}")
    for layer in ("clean", "rel"):
        for t, pk in ((_RV, "review_id"), (_RA, "aspect_id"), (_PR, "property_id")):
            add("V3", layer, t, pk, "FAIL", "no repeated key", f"(SELECT count(*) - count(DISTINCT {pk}) FROM {layer}_{t})", "= 0")
    for layer in ("clean", "rel"):
        add("V3", layer, _RV, "review_id", "FAIL", "no missing value", _count(f"{layer}_{_RV}", "review_id IS NULL"), "= 0")
    for t, c in ((_RV, "overall_score"), (_RA, "score")):
        for layer in ("clean", "rel"):
            add("V4", layer, t, c, "FAIL", "scores from 0 to 10", _count(f"{layer}_{t}", f"{c} < 0 OR {c} > 10"), "= 0")
    add("V5", "rel", _RV, "overall_score", "WARN", "plausible average", "(SELECT round(avg(overall_score), 2) FROM rel_reviews)",
        "BETWEEN 5 AND 10", "FAIL")
    add("V5", "rel", _RA, "score", "WARN", "plausible average", "(SELECT round(avg(score), 2) FROM rel_review_aspects)",
        "BETWEEN 5 AND 10", "SKIP")
    for layer in ("clean", "rel"):
        add("V6", layer, _RV, "departure_date", "WARN", "departure not before arrival",
            _count(f"{layer}_{_RV}", "CAST(departure_date AS DATE) < CAST(arrival_date AS DATE)"), "= 0")
    for layer in ("clean", "rel"):
        add("V6", layer, _RV, "created_at", "WARN", "nothing created in the future",
            _count(f"{layer}_{_RV}", "CAST(created_at AS TIMESTAMP) > TIMESTAMP '2026-01-01 00:00:00'"), "= 0")
    for layer, t, c, sev in (("clean", _RV, "external_property_id", "WARN"), ("clean", _RV, "created_at", "FAIL"),
                             ("clean", _RV, "sales_channel_code", "FAIL"), ("rel", _RV, "external_property_id", "WARN"),
                             ("rel", _RV, "sales_channel_code", "FAIL"), ("clean", _RA, "aspect_id", "FAIL"),
                             ("clean", _RA, "review_id", "FAIL"), ("clean", _RA, "aspect", "FAIL"), ("rel", _RA, "aspect_id", "FAIL")):
        add("V7", layer, t, c, sev, "no missing value", _count(f"{layer}_{t}", f"{c} IS NULL"), "= 0")
    for layer in ("clean", "rel"):
        add("V8", layer, _RA, "review_id", "FAIL", "every review exists",
            f"(SELECT count(*) FROM {layer}_{_RA} a WHERE NOT EXISTS (SELECT 1 FROM {layer}_{_RV} r WHERE r.review_id = a.review_id))", "= 0")
    only = "(SELECT count(DISTINCT review_id) FROM {a} WHERE review_id NOT IN (SELECT review_id FROM {b}))"
    add("V9", "clean/rel", _RV, "review_id", "FAIL", "the same keys",
        only.format(a="clean_reviews", b="rel_reviews") + " + " + only.format(a="rel_reviews", b="clean_reviews"), "= 0")
    add("V9", "clean/rel", _RV, "overall_score", "FAIL", "the same scores",
        "(SELECT count(*) FROM clean_reviews a JOIN rel_reviews b USING (review_id) "
        "WHERE CAST(a.overall_score AS DOUBLE) <> CAST(b.overall_score AS DOUBLE))", "= 0")
    return out


_LAYERS = """
raw_reviews AS (SELECT review_id FROM rv), raw_review_aspects AS (SELECT id FROM asp), raw_properties AS (SELECT k FROM praw),
clean0_reviews AS (SELECT review_id, external_property_id, arrival_txt AS arrival_date, departure_txt AS departure_date,
                          created_txt AS created_at, overall_score, sales_channel_code FROM rv),
rel0_reviews AS (SELECT review_id, external_property_id, arrival_date, departure_date, created_at, overall_score, sales_channel_code
                 FROM rel_reviews0),
clean0_review_aspects AS (SELECT id AS aspect_id, parent_id AS review_id, f AS aspect, score FROM asp),
rel0_review_aspects AS (SELECT * FROM clean0_review_aspects),
clean0_properties AS (SELECT id AS property_id FROM praw), rel_properties AS (SELECT property_id FROM rel_props),
"""
_WHOLE_LAYERS = """
clean_reviews AS (SELECT * FROM clean0_reviews), rel_reviews AS (SELECT * FROM rel0_reviews),
clean_review_aspects AS (SELECT * FROM clean0_review_aspects), rel_review_aspects AS (SELECT * FROM rel0_review_aspects),
clean_properties AS (SELECT * FROM clean0_properties)
"""
_FAULTY_LAYERS = """
clean_reviews AS (SELECT review_id, external_property_id, arrival_date,
    CASE WHEN CAST(review_id AS BIGINT) % 41 = 3 THEN '1990-01-01' ELSE departure_date END AS departure_date,
    CASE WHEN CAST(review_id AS BIGINT) % 43 = 4 THEN '2030-01-01 00:00:00' ELSE created_at END AS created_at,
    CASE WHEN CAST(review_id AS BIGINT) % 50 = 1 THEN 11.0 ELSE overall_score END AS overall_score,
    CASE WHEN CAST(review_id AS BIGINT) % 31 <> 2 THEN sales_channel_code END AS sales_channel_code
  FROM clean0_reviews WHERE CAST(review_id AS BIGINT) % 101 <> 0),
some_reviews AS (SELECT * FROM rel0_reviews WHERE CAST(review_id AS BIGINT) % 97 <> 5),
rel_reviews AS (SELECT * REPLACE (CASE WHEN CAST(review_id AS BIGINT) % 53 = 7 THEN overall_score - 20 ELSE overall_score END AS overall_score)
  FROM (SELECT * FROM some_reviews UNION ALL SELECT * FROM some_reviews WHERE CAST(review_id AS BIGINT) % 89 = 6)),
clean_review_aspects AS (SELECT * REPLACE (CASE WHEN aspect_id % 59 <> 0 THEN aspect END AS aspect) FROM clean0_review_aspects),
rel_review_aspects AS (SELECT * REPLACE (CASE WHEN aspect_id % 61 = 0 THEN 'x' ELSE review_id END AS review_id) FROM rel0_review_aspects),
clean_properties AS (SELECT * FROM clean0_properties WHERE CAST(property_id AS BIGINT) < 5)
"""


def checks_sql(layers: str) -> str:
    rows = []
    for i, (fam, layer, table, column, sev, title, observed, passes, null_status) in enumerate(_checks(), start=1):
        obs = f"CAST({observed} AS DOUBLE)"
        status = f"CASE WHEN {obs} {passes} THEN 'PASS' ELSE '{sev}' END"
        if null_status:
            status = f"CASE WHEN {obs} IS NULL THEN '{null_status}' ELSE {status} END"
        col = "NULL" if column is None else f"'{column}'"
        rows.append(f"SELECT {i} AS check_id, '{fam}' AS family, '{title}' AS check_name, '{layer}' AS layer, '{table}' AS table_name, "
                    f"CAST({col} AS VARCHAR) AS column_name, '{sev}' AS severity, {status} AS status, {obs} AS observed")
    model = MODEL.replace("rel_reviews", "rel_reviews0")  # the checks' own name for the layer's table
    return f"{model}, {_LAYERS} {layers} " + " UNION ALL ".join(rows)


_PAGE_EL = "CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)"

ORACLE = {
    "pages_explode": f"""
        SELECT conv_id * {C.PAGE_STRIDE} + turn // {C.TURNS_PER_PAGE} AS page,
               row_number() OVER (PARTITION BY conv_id, turn // {C.TURNS_PER_PAGE} ORDER BY turn) - 1 AS pos,
               {_PAGE_EL} AS id, role, text FROM conversations""",
    "pages_quarantine": f"""
        WITH p AS (SELECT DISTINCT conv_id, conv_id * {C.PAGE_STRIDE} + turn // {C.TURNS_PER_PAGE} AS page
                   FROM conversations),
        q AS (SELECT page, CASE WHEN conv_id % 10 = 0 THEN 'bad_json' ELSE 'data_not_list' END AS reason,
                     CAST(1 AS BIGINT) AS dropped,
                     CAST(length(CASE conv_id % 10 WHEN 0 THEN '{{"data": [' WHEN 1 THEN '{{"items": []}}'
                                  ELSE '{{"data": {{"id": "x"}}}}' END) AS BIGINT) AS stored_chars
              FROM p WHERE conv_id % 10 IN (0, 1, 2)),
        e AS (SELECT conv_id * {C.PAGE_STRIDE} + turn // {C.TURNS_PER_PAGE} AS page,
                     CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN 'not_object'
                          WHEN turn % 3 = 2 THEN 'no_id' END AS reason
              FROM conversations WHERE conv_id % 10 NOT IN (0, 1, 2))
        SELECT * FROM q
        UNION ALL
        SELECT page, reason, count(*) AS dropped, CAST(NULL AS BIGINT) AS stored_chars
        FROM e WHERE reason IS NOT NULL GROUP BY page, reason""",
    "incremental_scan": """
        SELECT *, CASE WHEN o_orderkey > (SELECT CAST(trunc(max(o_orderkey) / 2) AS BIGINT) FROM orders) THEN 2 ELSE 1 END AS load_run
        FROM orders""",
    "increment_passes": """
        WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
        r AS (SELECT *, max(y) OVER (PARTITION BY o_custkey) AS newest, min(y) OVER () AS start,
                     CAST(trunc(max(o_custkey) OVER () / 2) AS BIGINT) AS middle FROM o)
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST((y - start) * 2 + CASE WHEN o_custkey > middle THEN 2 ELSE 1 END AS INTEGER) AS load_run
        FROM r WHERE y = newest""",
    "run_commit": """
        WITH runs AS (SELECT 'pinned' AS reader, * FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'newest', * FROM orders),
        sums AS (SELECT reader, o_custkey AS custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
                 FROM runs GROUP BY ALL)
        SELECT reader, custkey, n AS raw_n, n AS rel_n, value AS raw_value, value AS rel_value FROM sums""",
    "csv_all_string": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey,
               CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE n_name END AS n_name,
               r_name AS regi_o_nome, lower(n_name) AS n_name_1, n_name || chr(10) || r_name AS note
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "refresh_counts": """
        SELECT 'part' AS table_name, count(*) AS rows_read, count(*) AS rows_stored FROM part
        UNION ALL SELECT 'supplier', count(*), count(*) FROM supplier""",
    "guarded_load": "SELECT * FROM part",
    "publish_roundtrip": """
        SELECT 'supplier' AS table_name, CAST(s_suppkey AS BIGINT) AS key, s_name AS name FROM supplier
        UNION ALL SELECT 'part', CAST(p_partkey AS BIGINT), p_name FROM part""",
    "dead_letter": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key,
               CASE (l_orderkey + l_linenumber) % 9 WHEN 0 THEN 'fractional value' ELSE 'infinite value' END || ' in l_quantity' AS error
        FROM lineitem WHERE (l_orderkey + l_linenumber) % 9 IN (0, 1)""",
    "dead_letter_all": f"""
        WITH r AS (
          SELECT 'properties' AS table_name, CASE WHEN c_custkey % 20 = 3 THEN 'fractional value in property_id'
                 WHEN c_custkey % 20 = 7 THEN 'value out of range in max_occupancy' ELSE 'stored' END AS outcome FROM customer
          UNION ALL
          SELECT 'property_id_mapping', CASE WHEN c_custkey % 30 = 1 THEN 'not a number in external_property_id'
                 WHEN c_custkey % 30 = 2 THEN 'value out of range in property_id' ELSE 'stored' END FROM customer
          UNION ALL
          SELECT 'reviews', CASE o_orderkey % 25 WHEN 4 THEN 'fractional value in booking_id' WHEN 5 THEN 'infinite value in booking_id'
                 WHEN 6 THEN 'value out of range in booking_id' ELSE 'stored' END FROM orders
          UNION ALL
          SELECT 'review_aspects', CASE WHEN (l_orderkey * 8 + l_linenumber) % 40 = 0 THEN 'fractional value in aspect_id'
                 ELSE 'stored' END FROM lineitem)
        SELECT table_name, outcome, count(*) AS n FROM r GROUP BY 1, 2""",
    "sanitize_names": """
        WITH s AS (SELECT p_partkey, p_name || ' ' || p_type || '.' || repeat('-x', p_size) AS source_name FROM part),
        c AS (SELECT p_partkey, source_name,
                     lower(regexp_replace(regexp_replace(source_name, '[^a-zA-Z0-9_]', '_', 'g'), '^_+|_+$', '', 'g')) AS c0
              FROM s),
        d AS (SELECT p_partkey, source_name, CASE WHEN c0 = '' THEN 'col' ELSE c0 END AS c1 FROM c)
        SELECT p_partkey, source_name,
               CASE WHEN length(c1) > 64 THEN substr(c1, 1, 55) || '_' || substr(md5(c1), 1, 8) ELSE c1 END AS column_name
        FROM d""",
    "dense_ids": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders",
    "aspect_type": """
        WITH t AS (SELECT l_orderkey, l_linenumber,
            CASE l_linenumber % 3 WHEN 0 THEN '{"type": "' || l_returnflag || '"}'
                 WHEN 1 THEN '{"x":{"type" : "' || l_linestatus || '"},"type":"' || l_returnflag || '"}'
                 ELSE l_returnflag END AS evaluationaspect FROM lineitem)
        SELECT l_orderkey, l_linenumber, evaluationaspect,
               nullif(regexp_extract(evaluationaspect, '"type"\\s*:\\s*"([^"]+)"', 1), '') AS aspect FROM t""",
    "gps_split": """
        WITH t AS (SELECT c_custkey, CASE c_custkey % 4
                     WHEN 0 THEN CAST(c_acctbal AS VARCHAR) || ', ' || CAST(-c_acctbal AS VARCHAR)
                     WHEN 1 THEN CAST(c_acctbal AS VARCHAR) || ','
                     WHEN 2 THEN CAST(c_acctbal AS VARCHAR) || '.1.2, 5'
                     ELSE CAST(c_acctbal AS VARCHAR) || ' , ' || CAST(c_nationkey AS VARCHAR) END AS g FROM customer)
        SELECT c_custkey, g AS gps_coordinates, {lat} AS latitude, {lon} AS longitude FROM t""".format(
        lat=sql_gps("g")[0], lon=sql_gps("g")[1]),
    "length_limits": """
        SELECT 'part' AS table_name, column_name, max_len, violations, longest FROM (
          SELECT 'p_name' AS column_name, 10 AS max_len, count(*) FILTER (length(p_name) > 10) AS violations,
                 CAST(max(length(p_name)) AS INTEGER) AS longest FROM part
          UNION ALL SELECT 'p_brand', 8, count(*) FILTER (length(p_brand) > 8), CAST(max(length(p_brand)) AS INTEGER) FROM part
          UNION ALL SELECT 'p_type', 6, count(*) FILTER (length(p_type) > 6), CAST(max(length(p_type)) AS INTEGER) FROM part)""",
    "content_hash": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               md5('{"l_linenumber":' || l_linenumber || ',"l_linestatus":"' || l_linestatus || '","l_orderkey":'
                   || l_orderkey || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}') AS row_hash
        FROM lineitem""",
    "child_dedup": """
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS parent_id, l_linenumber, l_returnflag, l_linestatus
        FROM lineitem""",
    "change_detect": f"""
        SELECT DISTINCT CAST(CASE WHEN l_orderkey % 7 = 1 THEN l_orderkey + {C.NEW_PARENT_OFFSET} ELSE l_orderkey END AS VARCHAR)
               AS parent_id,
               CASE l_orderkey % 7 WHEN 0 THEN 'changed' WHEN 1 THEN 'new' ELSE 'unchanged' END AS status
        FROM lineitem""",
    "replace_children": f"""
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS parent_id, CAST(l_linenumber AS BIGINT) AS n, l_returnflag AS f,
               l_quantity AS q, l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_orderkey % 7 <> 0
        UNION
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS BIGINT), l_returnflag, l_quantity + 1, l_partkey,
               l_suppkey FROM lineitem WHERE l_orderkey % 7 = 0
        UNION
        SELECT DISTINCT CAST(l_orderkey + {C.NEW_PARENT_OFFSET} AS VARCHAR), CAST(l_linenumber AS BIGINT), l_returnflag,
               l_quantity, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 7 = 1""",
    "incremental_build": f"""
        WITH lines AS (SELECT DISTINCT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, l_returnflag AS f, l_quantity AS q, l_partkey AS p,
                              l_suppkey AS s FROM lineitem),
        one AS (SELECT CAST(k AS VARCHAR) AS parent_id, n, f, q, p, s, k % 7 = 0 AS changes,
                       row_number() OVER (ORDER BY CAST(k AS VARCHAR), n, f, q, p, s) AS id FROM lines),
        two AS (SELECT CAST(CASE WHEN k % 7 = 1 THEN k + {C.NEW_PARENT_OFFSET} ELSE k END AS VARCHAR) AS parent_id, n, f,
                       CASE WHEN k % 7 = 0 THEN q + 1 ELSE q END AS q, p, s FROM lines WHERE k % 7 IN (0, 1)),
        met AS (SELECT two.*, one.id AS old FROM two LEFT JOIN one USING (parent_id, n, f, q, p, s))
        SELECT CAST(id AS BIGINT) AS id, parent_id, n, f, q, p, s FROM one WHERE NOT changes
        UNION ALL SELECT CAST(old AS BIGINT), parent_id, n, f, q, p, s FROM met WHERE old IS NOT NULL
        UNION ALL SELECT CAST((SELECT count(*) FROM one) + row_number() OVER (ORDER BY parent_id, n, f, q, p, s) AS BIGINT), parent_id, n, f, q, p, s
                  FROM met WHERE old IS NULL""",
    "drift_applied": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CASE WHEN o_orderkey % 2 = 0 THEN CAST(floor(o_totalprice) AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS price,
               CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority
        FROM orders""",
    "delta_batches": f"""
        WITH e AS (SELECT *, {C.DELTA_BATCHES - 1} - (event_id // {C.EVENTS_PER_PAGE}) * {C.DELTA_BATCHES}
                             // (1 + (SELECT max(event_id) FROM events) // {C.EVENTS_PER_PAGE}) AS batch FROM events)
        SELECT CAST(user_id AS VARCHAR) AS id, event_type AS field, value FROM e
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY batch DESC, event_id DESC) = 1""",
    "field_upsert": """
        SELECT CAST(user_id AS VARCHAR) AS id, event_type AS field, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "page_stream_upsert": """
        SELECT CAST(user_id AS VARCHAR) AS id, event_type AS field, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "two_day_upsert": f"""
        SELECT CAST(user_id AS VARCHAR) AS id, event_type AS field, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts >= TIMESTAMP '{C.UPSERT_SPLIT_TS}' DESC, event_id DESC) = 1""",
    "upsert_metrics": f"""
        WITH b AS (SELECT user_id, event_type, value FROM events WHERE ts < TIMESTAMP '{C.UPSERT_SPLIT_TS}'
                   QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
        a AS (SELECT user_id, event_type, value FROM events
              QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
        bu AS (SELECT DISTINCT user_id FROM b),
        d AS (SELECT a.user_id, max(CASE WHEN b.user_id IS NULL OR a.value IS DISTINCT FROM b.value THEN 1 ELSE 0 END) AS diff
              FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type GROUP BY a.user_id)
        SELECT count(*) FILTER (d.user_id NOT IN (SELECT user_id FROM bu)) AS upserted,
               count(*) FILTER (d.user_id IN (SELECT user_id FROM bu)) AS matched,
               count(*) FILTER (d.user_id IN (SELECT user_id FROM bu) AND diff = 1) AS modified,
               count(*) AS total FROM d""",
    "row_upsert": f"""
        WITH t AS (SELECT user_id, event_type, value, ts FROM events WHERE ts < TIMESTAMP '{C.UPSERT_SPLIT_TS}'
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
        u AS (SELECT user_id, value, ts FROM events WHERE ts >= TIMESTAMP '{C.UPSERT_SPLIT_TS}'
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT coalesce(t.user_id, u.user_id) AS user_id, t.event_type,
               CASE WHEN u.user_id IS NOT NULL THEN u.value ELSE t.value END AS value,
               CASE WHEN u.user_id IS NOT NULL THEN u.ts ELSE t.ts END AS ts
        FROM t FULL OUTER JOIN u ON t.user_id = u.user_id""",
    "floor_standardise": None,   # filled below
    "pk_violations": f"""
        WITH m AS (SELECT * FROM customer WHERE c_custkey % {R.MAPPING_GAP_MOD} <> {R.MAPPING_GAP_REM})
        SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS key_columns, count(*) AS rows,
               count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus_rows,
               count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) AS null_keys FROM lineitem
        UNION ALL
        SELECT 'orders', 'o_orderkey', count(*), count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey),
               count(*) FILTER (o_orderkey IS NULL) FROM orders
        UNION ALL
        SELECT 'property_id_mapping', 'external_property_id', count(*), count(DISTINCT c_custkey),
               count(*) - count(DISTINCT c_custkey), 0 FROM m""",
    "orphan_aspects": f"""
        SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % {C.ORDER_GAP_MOD} <> 0)""",
    "fk_enforce": f"""
        SELECT 'lineitem->orders' AS relation,
               (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphans,
               CASE WHEN (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0
                    THEN 'ok' ELSE 'violated' END AS status
        UNION ALL
        SELECT 'lineitem->surviving_orders',
               (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN
                  (SELECT o_orderkey FROM orders WHERE o_orderkey % {C.ORDER_GAP_MOD} <> 0)),
               CASE WHEN (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN
                  (SELECT o_orderkey FROM orders WHERE o_orderkey % {C.ORDER_GAP_MOD} <> 0)) = 0 THEN 'ok' ELSE 'violated' END""",
    "cascade_delete": f"""
        SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % {C.ORDER_GAP_MOD} <> 0)""",
    "value_parity": """
        SELECT count(*) AS matched,
               count(*) FILTER (CAST(CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS DOUBLE) <> CAST(l.quality AS DOUBLE)) AS mismatched
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""",
    "key_parity": f"""
        WITH l AS (SELECT DISTINCT o_orderkey FROM orders),
        r AS (SELECT DISTINCT CASE WHEN o_orderkey % 10 = 1 THEN o_orderkey + {C.SHIFT_OFFSET} ELSE o_orderkey END AS o_orderkey
              FROM orders WHERE o_orderkey % 10 <> 0)
        SELECT count(*) FILTER (r.o_orderkey IS NULL) AS only_left, count(*) FILTER (l.o_orderkey IS NULL) AS only_right,
               count(*) FILTER (l.o_orderkey IS NOT NULL AND r.o_orderkey IS NOT NULL) AS both
        FROM l FULL OUTER JOIN r ON l.o_orderkey = r.o_orderkey""",
    "score_distribution": """
        SELECT l_returnflag AS aspect, round(avg(l_quantity / 5), 2) AS avg_score, count(*) AS n
        FROM lineitem GROUP BY l_returnflag""",
    "infer_types": """
        WITH docs AS (SELECT to_json(orders) AS j FROM orders UNION ALL SELECT to_json(events) FROM events),
        kv AS (SELECT unnest(json_keys(j)) AS k, j FROM docs),
        t AS (SELECT k, json_type(j, '$."' || k || '"') AS jt FROM kv),
        r AS (SELECT k, max(CASE jt WHEN 'BOOLEAN' THEN 1 WHEN 'BIGINT' THEN 2 WHEN 'UBIGINT' THEN 2
                                    WHEN 'DOUBLE' THEN 3 ELSE 99 END) AS rk FROM t GROUP BY k)
        SELECT 'parent' AS scope, k AS field,
               CASE rk WHEN 1 THEN 'BOOLEAN' WHEN 2 THEN 'BIGINT' WHEN 3 THEN 'DOUBLE' ELSE 'STRING' END AS data_type
        FROM r WHERE k NOT IN ('id', '_id')
        UNION ALL
        SELECT * FROM (VALUES ('parent', 'hash_lines', 'STRING'), ('lines', 'n', 'BIGINT'), ('lines', 'f', 'STRING'),
                              ('lines', 'q', 'DOUBLE'), ('lines', 'p', 'BIGINT'), ('lines', 's', 'BIGINT'))
        WHERE (SELECT count(*) FROM lineitem) > 0""",
}


def _types_of(src: str) -> str:
    return f"""(SELECT k, max(CASE jt WHEN 'BOOLEAN' THEN 1 WHEN 'BIGINT' THEN 2 WHEN 'UBIGINT' THEN 2
                                   WHEN 'DOUBLE' THEN 3 ELSE 99 END) AS rk
               FROM (SELECT k, json_type(j, '$."' || k || '"') AS jt
                     FROM (SELECT unnest(json_keys(j)) AS k, j FROM ({src}))) GROUP BY k)"""


_TYPE_NAME = "CASE {r} WHEN 1 THEN 'BOOLEAN' WHEN 2 THEN 'BIGINT' WHEN 3 THEN 'DOUBLE' ELSE 'STRING' END"

ORACLE["schema_drift"] = f"""
    WITH o AS {_types_of("SELECT to_json(orders) AS j FROM orders")},
    n AS {_types_of("SELECT to_json(orders) AS j FROM orders UNION ALL SELECT to_json(events) FROM events "
                    "UNION ALL SELECT to_json({'o_orderkey': o_orderkey, 'o_custkey': CAST(o_custkey AS VARCHAR)}) "
                    "FROM orders WHERE o_orderkey % 100 = 0")}
    SELECT 'parent' AS scope, n.k AS field, CASE WHEN o.rk IS NULL THEN NULL ELSE {_TYPE_NAME.format(r='o.rk')} END AS old_type,
           {_TYPE_NAME.format(r='n.rk')} AS new_type,
           CASE WHEN o.rk IS NULL THEN 'added' ELSE 'widened' END AS change
    FROM n LEFT JOIN o ON n.k = o.k
    WHERE n.k NOT IN ('id', '_id') AND (o.rk IS NULL OR n.rk > o.rk)
    UNION ALL
    SELECT scope, field, NULL, new_type, 'added' FROM (VALUES ('parent', 'hash_lines', 'STRING'), ('lines', 'n', 'BIGINT'),
        ('lines', 'f', 'STRING'), ('lines', 'q', 'DOUBLE'), ('lines', 'p', 'BIGINT'), ('lines', 's', 'BIGINT')) AS v(scope, field, new_type)
    WHERE (SELECT count(*) FROM lineitem) > 0"""

_FLOOR_SRC = f"""
    WITH f AS (SELECT p_partkey AS id, CASE
        WHEN p_size % {len(R.FLOORS) + 3} = {len(R.FLOORS)} THEN 'Piso ' || CAST(p_size % 5 AS VARCHAR) || ' - ' || p_brand
        WHEN p_size % {len(R.FLOORS) + 3} = {len(R.FLOORS) + 1} THEN ' ' || CAST(p_size AS VARCHAR) || ' '
        WHEN p_size % {len(R.FLOORS) + 3} = {len(R.FLOORS) + 2} THEN 'rc ' || p_name
        ELSE {_case_list(f"p_size % {len(R.FLOORS) + 3}", R.FLOORS)} END AS andar FROM part)"""
ORACLE["floor_standardise"] = f"{_FLOOR_SRC} SELECT id AS p_partkey, andar AS floor_before, {sql_floor('andar')} AS floor FROM f"
ORACLE["floor_audit"] = (f"{_FLOOR_SRC} SELECT id AS property_id, andar AS floor_before, {sql_floor('andar')} AS floor_after "
                         f"FROM f WHERE andar IS DISTINCT FROM {sql_floor('andar')}")

ORACLE.update({
    "shred_parent": _q("""
        SELECT review_id AS id, mongo_id AS _id, external_property_id AS accommodationid, arrival_txt AS arrivaldate,
               booking_id AS bookingid, created_txt AS createdat, customer_name AS customername,
               departure_txt AS departuredate, overall_score AS globalvaloration, language, likes_count AS likes,
               negative_comment AS negativecomment, neutral_comment AS neutralcomment,
               positive_comment AS positivecomment, response_text AS response, response_txt AS responsedate,
               sales_channel_code AS saleschannelcode, review_title AS title, validated, hash_evaluationaspects
        FROM rv LEFT JOIN lists ON parent_id = review_id"""),
    "shred_children": _q(f"""
        SELECT id, parent_id, md5(item) AS row_hash, TIMESTAMP '{R.LOADED_AT}' AS created_at, '{{"type":"' || f || '"}}' AS evaluationaspect,
               score AS valoration FROM asp"""),
    "shred_counts": """
        SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS processed,
               (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS skipped,
               (SELECT count(*) FROM orders) AS parents""",
    "rename_clean": _q("""
        SELECT review_id, mongo_id, external_property_id, arrival_txt AS arrival_date, booking_id,
               created_txt AS created_at, customer_name, departure_txt AS departure_date, overall_score, language,
               likes_count, negative_comment, positive_comment, response_text, response_txt AS response_date,
               sales_channel_code, review_title, validated AS is_validated, hash_evaluationaspects
        FROM rv LEFT JOIN lists ON parent_id = review_id"""),
    "first_present": _q(f"""
        SELECT id AS aspect_id, parent_id AS review_id, TIMESTAMP '{R.LOADED_AT}' AS created_at, f AS aspect, score
        FROM asp"""),
    "typed_relational": _q("SELECT * FROM rel_reviews"),
    "typed_properties": _whole("SELECT * FROM rel_props"),
    "typed_mapping": _whole("SELECT * FROM rel_map"),
    "postcode_split": _whole("SELECT id AS property_id, postcode_prefix, postcode_suffix FROM pclean"),
    "postcode_zero": _whole("""
        SELECT id AS property_id,
               CASE WHEN TRY_CAST(postcode_prefix AS INTEGER) = 0 THEN NULL ELSE TRY_CAST(postcode_prefix AS INTEGER) END
                 AS postcode_prefix,
               CASE WHEN TRY_CAST(postcode_suffix AS INTEGER) = 0 THEN NULL ELSE TRY_CAST(postcode_suffix AS INTEGER) END
                 AS postcode_suffix
        FROM pclean"""),
    "stale_inactive": _whole("""
        SELECT id AS property_id, inativo AS is_inactive,
               CASE WHEN TRY_CAST(inativo AS BIGINT) = 0 THEN NULL ELSE data_inativo END AS inactive_date
        FROM praw"""),
    "review_report": _q("""
        SELECT r.review_id, r.external_property_id, m.property_id, p.team, r.overall_score
        FROM rel_reviews r LEFT JOIN rel_map m ON m.external_property_id = r.external_property_id
        LEFT JOIN rel_props p ON p.property_id = m.property_id"""),
    "orphan_counts": _q("""
        SELECT 'reviews->mapping' AS relation, count(*) AS orphans FROM rel_reviews
          WHERE external_property_id IS NOT NULL AND external_property_id NOT IN (SELECT external_property_id FROM rel_map)
        UNION ALL
        SELECT 'mapping->properties', count(*) FROM rel_map
          WHERE property_id IS NOT NULL AND property_id NOT IN (SELECT property_id FROM rel_props)
        UNION ALL
        SELECT 'documents->labels', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""),
    "key_parity_property": _q("""
        , l AS (SELECT DISTINCT external_property_id FROM rel_reviews),
        r AS (SELECT DISTINCT external_property_id FROM rel_map)
        SELECT count(*) FILTER (r.external_property_id IS NULL) AS only_left,
               count(*) FILTER (l.external_property_id IS NULL) AS only_right,
               count(*) FILTER (l.external_property_id IS NOT NULL AND r.external_property_id IS NOT NULL) AS both
        FROM l FULL OUTER JOIN r ON l.external_property_id = r.external_property_id"""),
    "row_parity": _q("""
        SELECT 'raw' AS layer, 'reviews' AS table_name, count(*) AS row_count FROM rv
        UNION ALL SELECT 'raw', 'reviews_evaluationaspects', count(*) FROM asp
        UNION ALL SELECT 'raw', 'propriedades', count(*) FROM praw
        UNION ALL SELECT 'clean', 'reviews', count(*) FROM rv
        UNION ALL SELECT 'clean', 'review_aspects', count(*) FROM asp
        UNION ALL SELECT 'clean', 'properties', count(*) FROM praw
        UNION ALL SELECT 'rel', 'reviews', count(*) FROM rv
        UNION ALL SELECT 'rel', 'review_aspects', count(*) FROM asp
        UNION ALL SELECT 'rel', 'properties', count(*) FROM rel_props"""),
    "validation_report": checks_sql(_WHOLE_LAYERS),
    "validation_faults": checks_sql(_FAULTY_LAYERS),
    "dim_date": _q("""
        , bounds AS (SELECT least(min(arrival_date), min(CAST(created_at AS DATE)), min(departure_date), min(response_date)) AS lo,
                          greatest(max(arrival_date), max(CAST(created_at AS DATE)), max(departure_date), max(response_date)) AS hi
                   FROM rel_reviews),
        days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
                 FROM bounds)
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, isodow(d) IN (6, 7) AS is_weekend
        FROM days""".replace("\n        , bounds", ", bounds", 1)),
    "dim_property": _whole("SELECT * FROM dim_property"),
    "dim_sales_channel": _q("SELECT * FROM dim_channel"),
    "dim_aspect": _q("SELECT * FROM dim_aspect"),
    "fact_reviews": _q("SELECT * FROM fact_reviews"),
    "fact_review_aspects": _q("""
        SELECT a.id AS aspect_id, a.parent_id AS review_id, coalesce(da.aspect_key, -1) AS aspect_key,
               coalesce(fr.property_key, -1) AS property_key, coalesce(fr.channel_key, -1) AS channel_key,
               fr.arrival_date_key AS date_key, a.score
        FROM asp a LEFT JOIN fact_reviews fr ON fr.review_id = a.parent_id
        LEFT JOIN dim_aspect da ON da.aspect = a.f"""),
})
