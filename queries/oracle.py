"""The same results in plain SQL, one text per registered query."""

from __future__ import annotations

from .inputs import with_inputs

# Column -> (type label, is numeric) of the profiled tables.
DIRTY = {
    "c_custkey": "bigint", "acctbal": "double", "nation": "int", "segment": "string", "active": "string",
    "opinion": "string", "in_credit": "boolean", "all_null": "double", "constant": "double",
}
SPIKY = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint", "l_suppkey": "bigint",
    "l_quantity": "double", "price": "double", "discount": "double", "l_tax": "double", "l_returnflag": "string",
}
DOCUMENTS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
EMBEDDINGS = {"vec_id": "bigint", "embedding": "array<float>", "label": "int"}
EVENTS = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
}
NUMBERS = ("bigint", "int", "double")
LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


def value(column: str, dtype: str) -> str:
    return f"case when isnan({column}) then null else {column} end" if dtype == "double" else column


def union(parts) -> str:
    return "\nunion all ".join(parts)


def missing_rows(source: str, columns: dict[str, str]) -> str:
    return union(
        f"""select '{c}' as "column", '{t}' as dtype, cast(count(*) - count({value(c, t)}) as bigint) as missing,
  round((count(*) - count({value(c, t)})) * 100.0 / count(*), 2) as missing_pct,
  cast(count(distinct {value(c, t)}) as bigint) as "unique", {str(t in NUMBERS).lower()} as is_numeric from {source}"""
        for c, t in columns.items()
    )


def mode(source: str, column: str, order: str) -> str:
    text = f"upper(cast({column} as varchar))" if column == "in_credit" else f"cast({column} as varchar)"
    return f"(select v from (select {text} as v, count(*) as n, min({order}) as f from {source} where {column} is not null group by 1) order by n desc, f, v limit 1)"


def summary_rows(source: str, columns: dict[str, str], order: str | None) -> str:
    def one(c: str, t: str) -> str:
        x = value(c, t)
        numeric = t in NUMBERS
        stats = {
            "mean": f"avg({x})", "sd": f"stddev_samp({x})", "min": f"min({x})",
            "median": f"quantile_cont({x}, 0.5)", "max": f"max({x})",
        }
        cells = ", ".join(
            (f"round(cast({e} as double), 4)" if numeric else "cast(null as double)") + f' as "{n}"'
            for n, e in stats.items()
        )
        top = "cast(null as varchar)" if numeric else f"coalesce({mode(source, c, order or c)}, 'Missing')"
        return f"""select '{c}' as "column", '{t}' as dtype, cast(count(*) - count({x}) as bigint) as missing,
  cast(count(distinct {x}) as bigint) as "unique", {cells}, {top} as top from {source}"""

    return union(one(c, t) for c, t in columns.items())


def pearson(source: str, columns: list[str]) -> str:
    return union(
        f"select '{a}' as x, '{b}' as y, "
        + ("max(1.0::double)" if a == b else f"round(corr({value(a, 'double')}, {value(b, 'double')}), 2) + 0.0")
        + f" as r from {source}"
        for a in columns
        for b in columns
    )


def level_codes(column: str, source: str = "orders", order: str = "o_orderkey") -> str:
    return f"(select {column} as v, cast(row_number() over (order by min({order})) as integer) as code from {source} group by 1)"


def quartiles(source: str, x: str, group: str) -> str:
    return f"""(select {group} as g, count({x}) as n, quantile_cont({x}, 0.25) as q1, quantile_cont({x}, 0.5) as median,
  quantile_cont({x}, 0.75) as q3, avg({x}) as mean from {source} where {x} is not null group by 1)"""


def box(source: str, x: str, group: str) -> str:
    inside = f"t.{x} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)"
    r = lambda e, n: f"round({e}, 4) as {n}"
    return f"""select q.g as "group", cast(count(*) as bigint) as n, {r(f'min(t.{x})', 'min')}, {r('any_value(q1)', 'q1')},
  {r('any_value(median)', 'median')}, {r('any_value(q3)', 'q3')}, {r(f'max(t.{x})', 'max')}, {r('any_value(mean)', 'mean')},
  {r(f'min(case when {inside} then t.{x} end)', 'whisker_low')}, {r(f'max(case when {inside} then t.{x} end)', 'whisker_high')},
  cast(count(*) filter (where not ({inside})) as bigint) as outliers
from {source} t join {quartiles(source, x, group)} q on {group if group.startswith("'") else 't.' + group} = q.g
where t.{x} is not null group by 1"""


def bins(source: str, x: str, n: int, color: str | None = None, where: str = "true") -> str:
    number = f"cast(least(floor(({x} - lo) / ((hi - lo) / {n})) + 1, {n}) as integer)"
    shade = f", {color} as color" if color else ""
    return f"""(select {number} as bin, any_value(lo) as lo, any_value(hi) as hi{shade}, cast(count(*) as bigint) as "count"
from {source}, (select min({x}) as lo, max({x}) as hi from {source}) d where {x} is not null and {where} group by {number}{', ' + color if color else ''})"""


def edges(n: int, places: int) -> str:
    return (
        f"round(lo + (bin - 1) * ((hi - lo) / {n}), {places}) as bin_start, "
        f"round(lo + bin * ((hi - lo) / {n}), {places}) as bin_end"
    )


def json_customer() -> str:
    return "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment from customer"


def fences(column: str) -> str:
    q1, q3 = f"quantile_cont({column}, 0.25)", f"quantile_cont({column}, 0.75)"
    return f"{q1} - 1.5 * ({q3} - {q1}) as {column}_lo, {q3} + 1.5 * ({q3} - {q1}) as {column}_hi"


def clamp(column: str) -> str:
    return (
        f"round(case when {column} < {column}_lo then {column}_lo "
        f"when {column} > {column}_hi then {column}_hi else {column} end, 4) as {column}"
    )


def scaled(centre: str, spread: str) -> str:
    cells = ", ".join(
        f"round(({c} - ({centre.format(c)})) / ({spread.format(c)}), 6) as {c}" for c in ("price", "discount")
    )
    stats = ", ".join(
        f"{e} as {name}"
        for c in ("price", "discount")
        for name, e in (
            (f"{c}_avg", f"avg({c})"), (f"{c}_sd", f"stddev_samp({c})"), (f"{c}_min", f"min({c})"),
            (f"{c}_max", f"max({c})"), (f"{c}_q1", f"quantile_cont({c}, 0.25)"),
            (f"{c}_med", f"quantile_cont({c}, 0.5)"), (f"{c}_q3", f"quantile_cont({c}, 0.75)"),
        )
    )
    return f"select {LINE_KEYS}, {cells}, cast(0 as double) as constant from spiky_lineitem, (select {stats} from spiky_lineitem) s"


def feature(expression: str) -> str:
    return f"""select c_custkey, round({expression}, 6) as feature
from (select c_custkey, case when isnan(acctbal) then null else acctbal end as a, cast(nation as double) as b from dirty_customer)"""


def onehot(column: str, levels: dict[str, str]) -> str:
    return ", ".join(f"cast({column} = '{v}' as integer) as {n}" for v, n in levels.items())


ACCT = "case when isnan(acctbal) then null else acctbal end"
BLANKS = "' ' || chr(9) || chr(10) || chr(13)"
MISSING_LIST = "('', 'na', 'n/a', 'null', 'none', 'nan')"


def no_tokens(column: str) -> str:
    t = f"trim({column}, {BLANKS})"
    return f"case when lower({t}) in {MISSING_LIST} then null else {t} end as {column}"


def full_chain(source: str) -> str:
    """The whole chain, step by step; statistics come from the table with copies removed."""
    return f"""select c_custkey, nation, segment, opinion, in_credit, active_yes, active_no, active_missing,
  round(acctbal, 6) as acctbal, round(acctbal * nation, 6) as score,
  round(case when acctbal * nation > -1 then ln(1 + acctbal * nation) end, 6) as log_score
from (
  select c_custkey, nation, coalesce(segment, (select v from segment_mode)) as segment, opinion,
    coalesce(in_credit, (select v from credit_mode)) as in_credit,
    cast(coalesce(active, 'Missing') = 'Yes' as integer) as active_yes,
    cast(coalesce(active, 'Missing') = 'No' as integer) as active_no,
    cast(coalesce(active, 'Missing') = 'Missing' as integer) as active_missing,
    (acctbal - (select lo from span)) / (select hi - lo from span) as acctbal
  from ({source}) where acctbal between (select q1 - 1.5 * (q3 - q1) from q) and (select q3 + 1.5 * (q3 - q1) from q)
) where acctbal between 0.1 and 0.9"""


FULL_STEPS = f"""distinct_customer as (select distinct * from clean_customer_dup),
medians as (select quantile_cont({ACCT}, 0.5) as m from distinct_customer),
filled as (select * replace (coalesce({ACCT}, (select m from medians)) as acctbal) from distinct_customer where nation is not null),
segment_mode as (select segment as v from filled where segment is not null group by 1 order by count(*) desc, min(c_custkey) limit 1),
credit_mode as (select in_credit as v from filled where in_credit is not null group by 1 order by count(*) desc, min(c_custkey) limit 1),
q as (select quantile_cont(acctbal, 0.25) as q1, quantile_cont(acctbal, 0.75) as q3 from filled),
span as (select min(acctbal) as lo, max(acctbal) as hi from filled
  where acctbal between (select q1 - 1.5 * (q3 - q1) from q) and (select q3 + 1.5 * (q3 - q1) from q))"""

CLEANED_STEPS = f"""distinct_customer as (select distinct * from clean_customer_dup),
cleaned as (select c_custkey,
  coalesce({ACCT}, (select quantile_cont({ACCT}, 0.5) from distinct_customer)) as acctbal,
  coalesce(cast(nation as double), (select avg(nation) from distinct_customer)) as nation,
  coalesce(segment, {mode('distinct_customer', 'segment', 'c_custkey')}) as segment,
  active, coalesce(opinion, 'Missing') as opinion, in_credit, all_null from distinct_customer)"""

MIXED_SQL = f"""select c_custkey,
  round(coalesce({ACCT}, (select quantile_cont({ACCT}, 0.5) from clean_customer)), 4) as acctbal, nation,
  coalesce(segment, (select segment from clean_customer where nation is not null and segment is not null
    group by 1 order by count(*) desc, min(c_custkey) limit 1)) as segment,
  opinion,
  coalesce(in_credit, (select in_credit from clean_customer
    where nation is not null and opinion is not null and in_credit is not null
    group by 1 order by count(*) desc, min(c_custkey) limit 1)) as in_credit
from clean_customer where nation is not null and opinion is not null"""

PRICE_MOMENTS = """(select count(price) as n, avg(price) as mean, quantile_cont(price, 0.5) as median, stddev_samp(price) as sd,
  min(price) as min, max(price) as max, quantile_cont(price, 0.25) as q1, quantile_cont(price, 0.75) as q3,
  count(*) - count(price) as missing from spiky_lineitem)"""

ORACLE: dict[str, str] = {
    "src_sample": "select * from customer",
    "src_dispatch": "select * from part",
    "src_csv": "select * from part",
    "src_json_records": json_customer(),
    "src_json_data": json_customer(),
    "src_json_columnar": json_customer(),
    "src_json_flatten": """select o_orderkey, o_totalprice as detail_total, o_orderpriority as detail_state_priority,
  o_orderstatus as detail_state_code from orders""",
    "src_parquet": "select * from supplier",
    "sink_csv_roundtrip": f"""select c_custkey, {ACCT} as acctbal, nation, segment, active, opinion, in_credit,
  cast(null as varchar) as all_null, constant from dirty_customer""",
    "proj_clean_names": """select c_custkey as cust_key, c_name as cust_key_1, c_nationkey as x_2nd, c_acctbal as "column",
  c_mktsegment as mkt_segment from customer""",
    "proj_unique_names": "select s_suppkey as a, s_name as a_2, s_nationkey as a_1, s_acctbal as a_3 from supplier",
    "proj_drop_cols": "select c_custkey, nation, segment, active, opinion, in_credit from dirty_customer",
    "str_trim": f"select c_custkey, trim(segment, {BLANKS}) as segment, trim(active, {BLANKS}) as active from dirty_customer",
    "std_missing_tokens": f"select c_custkey, {no_tokens('segment')}, {no_tokens('active')}, {no_tokens('opinion')} from dirty_customer",
    "std_yes_no": "select c_custkey, active, opinion from clean_customer",
    "std_full": "select c_custkey, nation, segment, active, opinion, in_credit, all_null, constant from clean_customer",
    "std_documents": f"select doc_id, {no_tokens('text')}, {no_tokens('lang')}, {no_tokens('source')}, n_chars from documents",
    "num_safe_cast": f"""select c_custkey, {ACCT} as acctbal, cast(nation as double) as nation,
  case when active = '0' then cast(0 as double) end as active, cast(in_credit as double) as in_credit from dirty_customer""",
    "filt_range": "select c_custkey, acctbal from dirty_customer where not isnan(acctbal) and acctbal between 0 and 5000",
    "filt_range_lines": "select l_orderkey, l_partkey, l_extendedprice from lineitem where l_extendedprice between 1000 and 2000",
    "filt_levels": "select o_orderkey, o_orderpriority from orders where o_orderpriority in ('1-URGENT', '5-LOW')",
    "filt_levels_boolean": "select c_custkey, in_credit from dirty_customer where in_credit",
    "filt_passthrough": "select c_custkey, nation, segment from dirty_customer",
    "filt_domain_num": f"""select floor(lo * 100) / 100.0 as "min", ceil(hi * 100) / 100.0 as "max",
  greatest(lo, -100.0) as "from", least(hi, 99999.0) as "to"
from (select min({ACCT}) as lo, max({ACCT}) as hi from dirty_customer)""",
    "filt_domain_cat": "select distinct segment as level from dirty_customer where segment is not null order by 1",
    "dup_remove": "select c_custkey, nation, segment, active, opinion, in_credit, all_null, constant from (select distinct * from dirty_customer_dup)",
    "dup_remove_few_columns": "select distinct l_returnflag, l_linestatus, l_quantity from lineitem",
    "dup_flag": """select c_custkey, nation, segment, active, opinion, in_credit, all_null, constant,
  row_number() over (partition by c_custkey, acctbal, nation, segment, active, opinion, in_credit, all_null, constant) > 1 as duplicate_flag
from dirty_customer_dup""",
    "dup_flag_hot": """select l_returnflag, l_linestatus, l_quantity,
  row_number() over (partition by l_returnflag, l_linestatus, l_quantity) > 1 as duplicate_flag from lineitem""",
    "dup_keep": "select c_custkey, nation, segment, active, opinion, in_credit, all_null, constant from dirty_customer_dup",
    "agg_dup_count": """select cast(count(*) - (select count(*) from (select distinct l_returnflag, l_linestatus, l_quantity from lineitem))
  as bigint) as duplicates from lineitem""",
    "miss_keep": "select c_custkey, nation, segment from clean_customer",
    "miss_drop_rows": "select c_custkey, acctbal from clean_customer where acctbal is not null and not isnan(acctbal)",
    "miss_mean": f"""select c_custkey, round(coalesce({ACCT}, (select avg({ACCT}) from clean_customer)), 4) as acctbal,
  round(coalesce(cast(nation as double), (select avg(nation) from clean_customer)), 4) as nation, cast(0 as double) as all_null from clean_customer""",
    "miss_median": f"""select c_custkey, round(coalesce({ACCT}, (select quantile_cont({ACCT}, 0.5) from clean_customer)), 4) as acctbal,
  round(coalesce(cast(nation as double), (select quantile_cont(nation, 0.5) from clean_customer)), 4) as nation, all_null from clean_customer""",
    "miss_zero": f"select c_custkey, coalesce({ACCT}, 0) as acctbal, coalesce(nation, 0) as nation from clean_customer",
    "miss_mode": f"""select c_custkey, coalesce(segment, {mode('clean_customer', 'segment', 'c_custkey')}) as segment,
  coalesce(opinion, {mode('clean_customer', 'opinion', 'c_custkey')}) as opinion,
  coalesce(in_credit, cast({mode('clean_customer', 'in_credit', 'c_custkey')} as boolean)) as in_credit from clean_customer""",
    "miss_label": """select c_custkey, coalesce(segment, 'Missing') as segment,
  coalesce(upper(cast(in_credit as varchar)), 'Missing') as in_credit from clean_customer""",
    "miss_mixed_order": MIXED_SQL,
    "prof_missing_cols": f'select "column", missing, missing_pct, is_numeric from ({missing_rows("dirty_customer", DIRTY)}) where missing > 0',
    "prof_missing": f'select "column", dtype, missing, missing_pct, "unique" from ({missing_rows("dirty_customer", DIRTY)})',
    "prof_missing_label": f"""select "column", "column" || ' (' || missing || ' missing, ' || regexp_replace(cast(missing_pct as varchar), '\\.0$', '')
  || '% missing)' as label from ({missing_rows("dirty_customer", DIRTY)}) where missing > 0""",
    "sort_missing": f"""select "column", missing, missing_pct, cast(row_number() over (order by missing_pct, "column") as integer) as axis_position
from ({missing_rows("dirty_customer", DIRTY)}) where missing > 0""",
    "prof_summary": summary_rows("clean_customer", DIRTY, "c_custkey"),
    "prof_summary_lines": summary_rows("spiky_lineitem", SPIKY, None),
    "prof_missing_documents": f'select "column", dtype, missing, missing_pct, "unique" from ({missing_rows("documents", DOCUMENTS)})',
    "prof_missing_embeddings": f'select "column", dtype, missing, missing_pct, "unique" from ({missing_rows("embeddings", EMBEDDINGS)})',
    "prof_summary_events": summary_rows("events", EVENTS, "event_id"),
    "agg_distinct": union(f"""select '{c}' as "column", cast(count(distinct {c}) as bigint) as "unique" from spiky_lineitem""" for c in SPIKY),
    "agg_mode_first": union(
        f"""(select '{c}' as "column", cast({c} as varchar) as mode, cast(count(*) as bigint) as mode_count from orders
  group by {c} order by count(*) desc, min(o_orderkey) limit 1)"""
        for c in ("o_orderpriority", "o_orderstatus", "o_custkey")
    ),
    "agg_mode_sorted": """select cast(o_custkey as varchar) as mode, cast(count(*) as bigint) as mode_count from orders
group by 1 order by count(*) desc, 1 limit 1""",
    "agg_quantiles": union(
        f"""select '{c}' as "column", {p}::double as prob, round(quantile_cont({c}, {p}), 4) as value from spiky_lineitem"""
        for c in ("price", "discount", "l_quantity")
        for p in (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    ),
    "stats_quick": f"""select cast(count(*) as bigint) as rows, 9::bigint as cols, 5::bigint as numeric, 4::bigint as non_numeric,
  cast(sum((({ACCT}) is null)::int + (nation is null)::int + (in_credit is null)::int + 1) as bigint) as missing,
  cast(count(*) - (select count(*) from (select distinct * from dirty_customer_dup)) as bigint) as duplicates from dirty_customer_dup""",
    "stats_stage": """select count(*) as rows, 11::bigint as cols, 8::bigint as numeric, 3::bigint as non_numeric,
  sum((l_orderkey is null)::int + (l_partkey is null)::int + (l_suppkey is null)::int + (l_linenumber is null)::int
    + (l_quantity is null)::int + (l_extendedprice is null)::int + (l_discount is null)::int + (l_tax is null)::int
    + (l_returnflag is null)::int + (l_linestatus is null)::int + (l_shipdate is null)::int)::bigint as missing,
  count(*) - (select count(*) from (select distinct * from lineitem)) as duplicates from lineitem""",
    "stats_compare": f"""select metric, before, after, after - before as delta,
  case when after = before then 'neutral' when (after > before) = (metric <> 'missing') then 'improved' else 'worse' end as verdict
from (
  select 'rows' as metric, (select count(*) from dirty_customer_dup) as before, (select count(*) from dirty_customer where nation is not null) as after
  union all select 'cols', 9, 8
  union all select 'numeric', 5, 4
  union all select 'non_numeric', 4, 4
  union all select 'missing',
    (select cast(sum((({ACCT}) is null)::int + (nation is null)::int + (in_credit is null)::int + 1) as bigint) from dirty_customer_dup),
    (select cast(sum((segment is null)::int + (active is null)::int + (opinion is null)::int + (in_credit is null)::int) as bigint)
     from clean_customer where nation is not null))""",
    "stats_overview": """select 'Rows: ' || format('{:,}', count(*)) || ' | Columns: 9 | Numeric: 8 | Non-numeric: 1 | Missing values: '
  || format('{:,}', count(*) - count(discount)) as overview from spiky_lineitem""",
    "stats_missing_warning": f"""select cast(sum((({ACCT}) is null)::int + (nation is null)::int + (in_credit is null)::int + 1) as bigint) as missing,
  true as warning from dirty_customer""",
    "lim_preview": "select * from customer order by c_custkey limit 12",
    "out_cap": f"""select {LINE_KEYS}, {clamp('price')}, {clamp('discount')}, cast(1 as double) as constant
from spiky_lineitem, (select {fences('price')}, {fences('discount')} from spiky_lineitem) f""",
    "out_remove": f"""select {LINE_KEYS}, price, discount from spiky_lineitem, (select {fences('price')}, {fences('discount')} from spiky_lineitem) f
where (price is null or price between price_lo and price_hi) and (discount is null or discount between discount_lo and discount_hi)""",
    "scale_standard": scaled("{0}_avg", "{0}_sd"),
    "scale_minmax": scaled("{0}_min", "{0}_max - {0}_min"),
    "scale_robust": scaled("{0}_med", "{0}_q3 - {0}_q1"),
    "enc_label": f"""select o_orderkey, p.code as o_orderpriority, s.code as o_orderstatus from orders
join {level_codes('o_orderpriority')} p on o_orderpriority = p.v join {level_codes('o_orderstatus')} s on o_orderstatus = s.v""",
    "enc_label_many": f"""select c_custkey, n.code as c_name, c_mktsegment from customer
join {level_codes('c_name', 'customer', 'c_custkey')} n on c_name = n.v""",
    "enc_label_documents": f"""select doc_id, t.code as text, l.code as lang, s.code as source from documents
join {level_codes('text', 'documents', 'doc_id')} t on text = t.v join {level_codes('lang', 'documents', 'doc_id')} l on lang = l.v
join {level_codes('source', 'documents', 'doc_id')} s on source = s.v""",
    "enc_onehot": f"""select o_orderkey, {onehot('o_orderstatus', {'F': 'o_orderstatus_f', 'O': 'o_orderstatus_o', 'P': 'o_orderstatus_p'})},
  {onehot('o_orderpriority', {
        '1-URGENT': 'o_orderpriority_1_urgent', '2-HIGH': 'o_orderpriority_2_high', '3-MEDIUM': 'o_orderpriority_3_medium',
        '4-NOT SPECIFIED': 'o_orderpriority_4_not_specified', '5-LOW': 'o_orderpriority_5_low'})} from orders""",
    "enc_onehot_missing": f"""select c_custkey, nation, {onehot("coalesce(active, 'Missing')", {
        'Yes': 'active_yes', 'No': 'active_no', 'Missing': 'active_missing'})} from clean_customer""",
    "feat_add": feature("a + b"),
    "feat_subtract": feature("a - b"),
    "feat_multiply": feature("a * b"),
    "feat_divide": feature("case when b <> 0 then a / b end"),
    "feat_log": feature("case when a > -1 then ln(1 + a) end"),
    "feat_square": feature("a * a"),
    "feat_sqrt": feature("case when a >= 0 then sqrt(a) end"),
    "feat_abs": feature("abs(a)"),
    "feat_chain": """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
  l_extendedprice * l_discount - l_tax as net,
  case when l_quantity <> 0 then l_extendedprice * l_discount / l_quantity end as per_unit,
  round(case when l_extendedprice * l_discount / nullif(l_quantity, 0) > -1
    then ln(1 + l_extendedprice * l_discount / nullif(l_quantity, 0)) end, 6) as log_unit from lineitem""",
    "eda_insight_num": f"""select cast(s.n as bigint) as n, round(mean, 3) as mean, round(median, 3) as median, round(sd, 3) as sd,
  round(min, 3) as "min", round(max, 3) as "max", round(q1, 3) as q1, round(q3, 3) as q3,
  round((select avg(pow(price - mean, 3)) / pow(avg(pow(price - mean, 2)), 1.5) from spiky_lineitem), 3) as skewness,
  cast(s.missing as bigint) as missing from {PRICE_MOMENTS} s""",
    "eda_insight_cat": """select cast(sum(n) as bigint) as n, cast(count(*) as bigint) as "unique",
  cast((select count(*) - count(segment) from clean_customer) as bigint) as missing,
  (select segment from clean_customer where segment is not null group by 1 order by count(*) desc, 1 limit 1) as mode,
  cast(max(n) as bigint) as mode_count
from (select segment, count(*) as n from clean_customer where segment is not null group by 1)""",
    "eda_insight_all_missing": """select 0::bigint as n, 0::bigint as "unique", cast(count(*) as bigint) as missing,
  'N/A' as mode, 0::bigint as mode_count from dirty_customer""",
    "eda_kurtosis": "select cast(count(price) as bigint) as n, round(kurtosis_pop(price), 3) as kurtosis from spiky_lineitem",
    "eda_corr": pearson("spiky_lineitem", [c for c, t in SPIKY.items() if t in NUMBERS]),
    "eda_corr_gaps": pearson("(select c_custkey, acctbal, nation from dirty_customer)", ["c_custkey", "acctbal", "nation"]).replace(
        "isnan(c_custkey)", "isnan(cast(c_custkey as double))").replace("isnan(nation)", "isnan(cast(nation as double))"),
    "eda_bar_count": 'select nation as value, cast(count(*) as bigint) as "count" from dirty_customer group by 1',
    "eda_bar_turns": 'select role as value, cast(count(*) as bigint) as "count" from conversations group by 1',
    "eda_bar_agg": """select l_returnflag as x, l_linestatus as color, cast(count(l_extendedprice) as bigint) as "count",
  round(sum(l_extendedprice), 2) as "sum", round(avg(l_extendedprice), 2) as mean, min(l_extendedprice) as "min", max(l_extendedprice) as "max"
from lineitem group by 1, 2""",
    "eda_histogram": f'select bin, {edges(30, 4)}, "count" from {bins("spiky_lineitem", "price", 30)}',
    "eda_histogram_color": f'select bin, {edges(20, 4)}, color, "count" from {bins("events", "value", 20, "event_type")}',
    "eda_histogram_text": 'select p_brand as value, cast(count(*) as bigint) as "count" from part group by 1',
    "eda_box": box("events", "value", "event_type"),
    "eda_box_all": box("spiky_lineitem", "price", "'all'"),
    "eda_box_outliers": f"""select event_type as "group", value from events join {quartiles('events', 'value', 'event_type')} q on event_type = q.g
where value not between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)""",
    "eda_violin": f"""select color as "group", bin, {edges(20, 6)}, "count", round("count" / (n * ((hi - lo) / 20)), 6) as density,
  round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3, round(mean, 6) as mean
from {bins("events", "value", 20, "event_type")} join {quartiles('events', 'value', 'event_type')} q on color = q.g""",
    "eda_scatter": """select acctbal as x, cast(nation as double) as y, opinion as color from dirty_customer
where acctbal is not null and not isnan(acctbal) and nation is not null""",
    "eda_trend": """select cast(count(*) as bigint) as n, round(regr_slope(price, l_quantity), 4) as slope,
  round(regr_intercept(price, l_quantity), 4) as intercept from spiky_lineitem where price is not null and l_quantity is not null""",
    "chain_clean": summary_rows("cleaned", {c: ("double" if c == "nation" else t) for c, t in DIRTY.items() if c != "constant"}, "c_custkey"),
    "chain_preprocess": f"""select {LINE_KEYS}, round((p - (select avg(p) from capped)) / (select stddev_samp(p) from capped), 6) as price,
  r.code as l_returnflag from capped
join (select l_returnflag as v, cast(row_number() over (order by l_returnflag) as integer) as code from lineitem group by 1) r on l_returnflag = r.v""",
    "chain_full": full_chain("select * from filled"),
    "chain_refit": full_chain(
        f"""select * replace (coalesce({ACCT}, (select m from medians)) as acctbal) from clean_customer where nation is not null"""
    ),
}

# Steps that some queries put in front of their last select.
STEPS = {
    "chain_clean": CLEANED_STEPS,
    "chain_preprocess": """capped as (select *, case when price < price_lo then price_lo when price > price_hi then price_hi else price end as p
from spiky_lineitem, (select """ + fences("price") + " from spiky_lineitem) f)",
    "chain_full": FULL_STEPS,
    "chain_refit": FULL_STEPS,
}


ORACLE |= {
    "src_csv_files": """select p_partkey, p_name || case p_partkey % 3 when 0 then '' when 1 then chr(10) || 'more'
  else ' 5" pipe' end as p_name from part""",
    "src_json_files": """select c_custkey, c_name, c_acctbal,
  case when floor(c_custkey / 100)::bigint % 2 = 0 then c_mktsegment end as c_mktsegment from customer""",
    "src_json_line_records": "select o_orderkey, o_orderstatus as code from orders",
    "src_json_refused": "select count(*) as rows, true as refused from orders",
    "src_json_large": "select doc_id, text, lang, n_chars from documents",
    "src_json_large_data": "select page_id, url, html from pages",
    "src_csv_spanning": "select doc_id, text, n_chars from documents",
    "src_csv_names": "select s_suppkey, s_nationkey, s_suppkey as s_suppkey_1 from supplier",
    "sink_dated": "select *, 'processed_data_2024-03-09.csv' as file from supplier",
    "sink_featured": "select c_custkey, nation, cast(nation + nation as double) as twice from dirty_customer",
    "miss_menu": union(
        f"""select '{c}' as "column", count(*) as missing, '{menu}' as menu from dirty_customer
  where {'acctbal is null or isnan(acctbal)' if c == 'acctbal' else f'{c} is null'} having count(*) > 0"""
        for c, menu in (
            *[(c, "keep, drop_rows, median, mean, zero") for c in ("c_custkey", "acctbal", "nation", "all_null", "constant")],
            *[(c, "keep, drop_rows, mode, missing_label") for c in ("segment", "active", "opinion", "in_credit")],
        )
    ),
    "feat_rules": """select c_custkey, round((c_acctbal - c_nationkey) * c_nationkey, 2) as total,
  round(c_acctbal - c_nationkey, 2) as total_2, 0 as after_reset from customer""",
    "feat_case": "select c_custkey, round((c_acctbal + c_nationkey) * c_nationkey, 2) as net from customer",
    "eda_points": """select 'acctbal' as x, 'nation' as y,
  count(*) filter (acctbal is not null and not isnan(acctbal) and nation is not null) > 0 as drawn, count(*) as rows from dirty_customer
union all select 'acctbal', 'all_null', count(*) filter (acctbal is not null and all_null is not null) > 0, count(*) from dirty_customer""",
    "filt_level_selection": """select distinct opinion as level, opinion in ('maybe', 'yes', 'absent') as selected
from dirty_customer where opinion is not null""",
    "agg_distinct_nested": """select * from (with o as (select o_orderstatus,
  case o_orderkey % 4 when 0 then ['a, b'] when 1 then ['a', 'b'] when 2 then [null::varchar] else ['null'] end as list,
  {'l': case when o_orderkey % 2 = 0 then 'x, y' else 'x' end, 'r': case when o_orderkey % 2 = 0 then 'z' else 'y, z' end} as pair
  from orders)
select 'list' as "column", (select count(*) from (select distinct list from o)) as "unique"
union all select 'pair', (select count(*) from (select distinct pair from o))
union all select 'o_orderstatus', (select count(*) from (select distinct o_orderstatus from o))
union all select 'embedding', (select count(*) from (select distinct embedding from embeddings)))""",
    "enc_label_null_keys": """select * from (with d as (select c_custkey, 'n' || nation as level,
  case when nation % 5 = 0 then null when nation % 7 = 0 then cast('NaN' as double) else acctbal end as key from dirty_customer),
f as (select coalesce(level, 'Missing') as v, min(key) as f from d group by 1),
codes as (select v, cast(row_number() over (order by f nulls first, v) as integer) as code from f)
select c_custkey, code as level from d join codes on coalesce(level, 'Missing') = v)""",
    "enc_label_refit": """select * from (with o as (select o_orderkey, o_custkey, 'c' || (o_custkey % 100) as level from orders),
codes as (select level as v, cast(row_number() over (order by level) as integer) as code
  from (select distinct level from o where o_custkey % 100 < 90))
select o_orderkey, code as level from o left join codes on v = case when o_orderkey % 3 = 0 then 'c7' else level end)""",
    "enc_onehot_sparse": f"""select * from (with d as (select doc_id, coalesce(source, 'Missing') as source, coalesce(lang, 'Missing') as lang,
  coalesce(text, 'Missing') as text from documents),
t as {level_codes('text', 'd', 'doc_id')}, l as {level_codes('lang', 'd', 'doc_id')}, s as {level_codes('source', 'd', 'doc_id')},
w as (select (select count(*) from s) as ns, (select count(*) from l) as nl, (select count(*) from t) as nt)
select doc_id, concat_ws(',', s.code - 1, ns + l.code - 1, ns + nl + t.code - 1) as active, cast(ns + nl + nt as bigint) as width
from d join s on source = s.v join l on lang = l.v join t on text = t.v, w)""",
    "enc_onehot_many": "select o_orderkey, "
    + ", ".join(f"cast(o_orderkey % 230 = {k} as integer) as v_k{k}" for k in range(230)) + " from orders",
}


def oracle_texts() -> dict[str, str]:
    out = {}
    for name, sql in ORACLE.items():
        text = with_inputs("select 1").removesuffix("select 1").rstrip() if name in STEPS else None
        out[name] = f"{text},\n{STEPS[name]}\n{sql}" if text else with_inputs(sql)
    return out
