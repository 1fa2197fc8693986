"""ANSI SQL for each query, run by DuckDB on the same tables."""

from __future__ import annotations

from tillstone.sources import synthetic

_BRONZE = """
bronze as (
  select cast(l_orderkey as varchar) as InvoiceNo,
         '  ' || cast(l_partkey as varchar) || ' ' as StockCode,
         p_name as Description,
         cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as int) as Quantity,
         strftime(o_orderdate, '%d/%m/%Y %H:%M') as InvoiceDate,
         cast(case when l_linenumber = 7 then 0.0 else p_retailprice end as real) as UnitPrice,
         cast(case when o_custkey % 10 = 0 then null else o_custkey end as real) as CustomerID,
         n_name as Country,
         l_linenumber
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join part on l_partkey = p_partkey
)"""

_SILVER = f"""{_BRONZE},
silver as (
  select trim(InvoiceNo) as InvoiceNo, trim(StockCode) as StockCode, trim(Description) as Description,
         Quantity, cast(UnitPrice as double) as UnitPrice, cast(CustomerID as bigint) as CustomerID,
         trim(Country) as Country, l_linenumber
  from bronze
  where Quantity > 0 and UnitPrice > 0 and CustomerID is not null
)"""

_GOLD = f"""{_SILVER},
gold as (
  select Country,
         count(InvoiceNo) as TotalTransactions,
         round(sum(Quantity * UnitPrice), 2) as TotalRevenue,
         cast(sum(Quantity) as bigint) as TotalQuantitySold,
         count(StockCode) as TotalItemsSold,
         count(distinct CustomerID) as UniqueCustomers,
         count(distinct StockCode) as UniqueProductsSold
  from silver group by Country
)"""

_FUNNEL = f"""{_BRONZE},
funnel as (
  select count(*) as bronze_rows,
         count(*) filter (where Quantity > 0) as after_quantity,
         count(*) filter (where Quantity > 0 and UnitPrice > 0) as after_price,
         count(*) filter (where Quantity > 0 and UnitPrice > 0 and CustomerID is not null) as after_customer,
         count(*) filter (where Quantity > 0 and UnitPrice > 0 and CustomerID is not null) as silver_rows
  from bronze
)"""


def _labels(column: str) -> str:
    return f"""{column}_labels as (
  select {column}, cast(row_number() over (order by count(*) desc, {column}) - 1 as double) as {column}Index
  from silver group by {column}
)"""


_FEATURES = f"""{_SILVER}, {_labels("Country")}, {_labels("StockCode")},
features as (
  select InvoiceNo, l_linenumber, StockCode, cast(CustomerID as double) as CustomerID, UnitPrice,
         CountryIndex, StockCodeIndex
  from silver join Country_labels using (Country) join StockCode_labels using (StockCode)
)"""

_SCORES = f"""{_SILVER},
scores as (
  select cast(Quantity as double) as y, avg(Quantity) over (partition by Country) as p from silver
)"""

_SCALED = ", ".join(
    f"round({c} / (select stddev_samp({c}) from features), 6) as {c}"
    for c in ("CustomerID", "UnitPrice", "CountryIndex", "StockCodeIndex")
)
_RAW_WIDE = (
    "InvoiceNo, StockCode, Description, Quantity, {date}cast(UnitPrice as double) as UnitPrice, "
    "cast(CustomerID as double) as CustomerID, Country"
)
_RAW = _RAW_WIDE.format(date="InvoiceDate, ")
_INGESTED = "'2024-01-01 00:00:00' as ingested_at"
_QUOTED = """'"' || replace(Description, ' ', '" "') || '", new' as Description"""
_LINE = "InvoiceNo, l_linenumber, StockCode"


def _hash(key: str, size: int, part: int = 0) -> str:
    return f"(cast('0x' || substr(md5({key}), {1 + 8 * part}, 8) as ubigint) % {size})"


def _draw(digest: int, part: int, size: int) -> str:
    return f"cast({_hash(f"'42|{digest}|' || cast(id as varchar)", size, part)} as bigint)"


def _pick(digest: int, part: int, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_draw(digest, part, len(values))} + 1]"


_SYNTHETIC = f"""
with ids as (select l_orderkey * 10 + l_linenumber as id from lineitem)
select printf('I%06d', id) as InvoiceNo,
       printf('S%03d', {_draw(0, 0, synthetic.STOCK_CODES)} + {synthetic.FIRST_STOCK_CODE}) as StockCode,
       printf('Product %d', {_draw(0, 1, synthetic.PRODUCTS)} + 1) as Description,
       cast({_draw(0, 2, synthetic.MAX_QUANTITY)} + 1 as int) as Quantity,
       strftime(timestamp '2024-01-01 12:00:00' - to_days(cast({_draw(0, 3, synthetic.DAYS_BACK)} + 1 as int)),
                '%d/%m/%Y %H:%M') as InvoiceDate,
       ({_draw(1, 0, synthetic.MAX_PRICE_CENTS - synthetic.MIN_PRICE_CENTS + 1)} + {synthetic.MIN_PRICE_CENTS})
         / 100.0::double as UnitPrice,
       {_draw(1, 1, synthetic.CUSTOMERS)} + {synthetic.FIRST_CUSTOMER} as CustomerID,
       {_pick(1, 2, synthetic.COUNTRIES)} as Country
from ids"""

_RUN_LOG = f"""with {_FUNNEL},
logged as (
  select 'metric' as kind, name, cast(value as varchar) as value
  from (unpivot funnel on bronze_rows, after_quantity, after_price, after_customer, silver_rows
        into name name value value)
  union all select 'param', 'n_estimators', '100'
  union all select 'param', 'max_depth', '15'
  union all select 'param', 'features', '[''CustomerID'', ''UnitPrice'', ''CountryIndex'', ''StockCodeIndex'']'
)
select 'check' as experiment, 'FINISHED' as status, kind, name, value from logged"""

_SPLIT = _hash("concat_ws('|', InvoiceNo, l_linenumber, StockCode)", 100)
_RUN_SPLIT = _hash("concat_ws('|', InvoiceNo, StockCode)", 100)

_REJECTS = f"""with {_BRONZE},
written as (
  select InvoiceNo, StockCode,
         case when cast(InvoiceNo as bigint) % 7 = 0 and l_linenumber = 1 then 'x' else '' end || Quantity as q,
         case when cast(InvoiceNo as bigint) % 11 = 0 and l_linenumber = 2 then 'n/a' else cast(UnitPrice as varchar) end as p,
         case when cast(InvoiceNo as bigint) % 13 = 0 and l_linenumber = 3 then '12.5.1' else cast(CustomerID as varchar) end as c
  from bronze
),
parsed as (
  select *, try_cast(q as int) as Quantity, try_cast(p as real) as UnitPrice, try_cast(c as real) as CustomerID from written
)
select InvoiceNo, StockCode, Quantity, cast(UnitPrice as double) as UnitPrice, cast(CustomerID as double) as CustomerID,
       (q is not null and Quantity is null) or (p is not null and UnitPrice is null)
         or (c is not null and CustomerID is null) as rejected
from parsed"""

_REVENUE = f"""{_SILVER},
lines as (select Quantity * UnitPrice as Revenue from silver)"""

_TRAINING_RUN = f"""with {_SILVER},
sides as (select {_RUN_SPLIT} < 80 as is_train from silver)
select 'FINISHED' as status, kind, name, value from (
  values ('param', 'n_estimators', '3'), ('param', 'max_depth', '4'),
         ('param', 'features', '[''CustomerID'', ''UnitPrice'', ''CountryIndex'', ''StockCodeIndex'']'),
         ('param', 'seed', '42'), ('param', 'train_percent', '80'), ('param', 'split', 'hash'),
         ('param', 'split_keys', 'InvoiceNo,StockCode'), ('param', 'fit_on', 'all'), ('param', 'handle_invalid', 'error'),
         ('param', 'max_memory_mb', '256'), ('param', 'cache_node_ids', 'True'), ('param', 'bootstrap', 'True'), ('param', 'split_seed', 'None'),
         ('metric', 'rmse', 'positive'), ('metric', 'r2', 'at most 1'),
         ('schema', 'silver', 'stored'), ('model', 'quantity_forest', '1')
) fixed(kind, name, value)
union all select 'FINISHED', 'rows', 'silver', cast(count(*) as varchar) from sides
union all select 'FINISHED', 'rows', 'train', cast(count(*) filter (where is_train) as varchar) from sides
union all select 'FINISHED', 'rows', 'test', cast(count(*) filter (where not is_train) as varchar) from sides"""

_GUARDS = f"""with {_SILVER}
select 'no columns' as guard, 'ValueError' as outcome, count(*) as rows from bronze
union all select 'empty bronze', '0 rows', 0
union all select 'no silver column', 'ValueError', count(*) from bronze
union all select 'no gold input', 'MissingColumnsError', count(*) from silver
union all select 'empty silver', 'FAILED silver', 0"""

ORACLE: dict[str, str] = {
    "gold_country": f"with {_GOLD} select * from gold",
    "gold_counts": f"with {_GOLD} select Country, TotalTransactions, TotalQuantitySold, TotalItemsSold from gold",
    "gold_revenue": f"with {_GOLD} select Country, TotalRevenue from gold",
    "gold_distinct": f"with {_GOLD} select Country, UniqueCustomers, UniqueProductsSold from gold",
    "gold_sorted": f"with {_GOLD} select * from gold order by Country nulls first",
    "line_revenue": f"with {_SILVER} select {_LINE}, Quantity * UnitPrice as Revenue from silver",
    "filter_quantity": f"with {_BRONZE} select {_LINE}, Quantity from bronze where Quantity > 0",
    "filter_price": f"with {_BRONZE} select {_LINE}, cast(UnitPrice as double) as UnitPrice "
    "from bronze where UnitPrice > 0",
    "filter_customer": f"with {_BRONZE} select {_LINE}, cast(CustomerID as double) as CustomerID "
    "from bronze where CustomerID is not null and not isnan(CustomerID)",
    "silver_drop_date": f"with {_BRONZE} select {_RAW_WIDE.format(date='')}, l_linenumber from bronze",
    "silver_casts": f"with {_BRONZE} select {_LINE}, Quantity, cast(UnitPrice as double) as UnitPrice, "
    "cast(CustomerID as bigint) as CustomerID from bronze",
    "silver_trim": f"with {_BRONZE} select trim(InvoiceNo) as InvoiceNo, l_linenumber, trim(StockCode) as StockCode, "
    "trim(Description) as Description, trim(Country) as Country from bronze",
    "silver_clean": f"with {_SILVER} select * exclude (l_linenumber) from silver",
    "cleaning_funnel": f"with {_FUNNEL} select * from funnel",
    "bronze_csv_scan": f"with {_BRONZE} select {_RAW} from bronze",
    "bronze_audit_column": f"with {_BRONZE} select {_LINE}, {_INGESTED}, true as live_time_is_one from bronze",
    "bronze_roundtrip": f"with {_BRONZE} select {_RAW}, {_INGESTED} from bronze",
    "silver_roundtrip": f"with {_SILVER} select * exclude (l_linenumber), {_INGESTED} from silver",
    "gold_roundtrip": f"with {_GOLD} select * from gold",
    "gold_clustered": f"with {_GOLD} select * from gold",
    "flow_gold": f"with {_GOLD} select * from gold",
    "index_country": f"with {_SILVER}, {_labels('Country')} select {_LINE}, Country, CountryIndex "
    "from silver join Country_labels using (Country)",
    "index_stock": f"with {_SILVER}, {_labels('StockCode')} select {_LINE}, StockCodeIndex "
    "from silver join StockCode_labels using (StockCode)",
    "assemble_features": f"with {_FEATURES} select * from features",
    "scale_features": f"with {_FEATURES} select {_LINE}, {_SCALED} from features",
    "split_train_test": f"with {_SILVER} select {_LINE}, "
    f"{_hash('''concat_ws('|', InvoiceNo, l_linenumber, StockCode)''', 100)} < 80 as is_train from silver",
    "eval_rmse": f"with {_SCORES} select round(sqrt(avg(pow(y - p, 2))), 6) as rmse from scores",
    "eval_r2": f"with {_SCORES} select round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 6) as r2 from scores",
    "run_log": _RUN_LOG,
    "synthetic_retail": _SYNTHETIC,
    "csv_doubled_quotes": f"with {_BRONZE} select {_RAW.replace('Description', _QUOTED)} from bronze",
    "bronze_rejects": _REJECTS,
    "rejected_lines": f"with {_BRONZE} select InvoiceNo, true as no_quantity, InvoiceNo as field_0, 'thing' as field_2, "
    "'many' as field_3 from bronze where cast(InvoiceNo as bigint) % 5 = 0",
    "revenue_layout": f"with {_REVENUE} select count(*) as rows, round(min(Revenue), 2) as least, "
    "round(max(Revenue), 2) as most, true as many_files, 0 as overlapping_files from lines",
    "revenue_range_read": f"with {_REVENUE} select count(*) as rows, round(sum(Revenue), 2) as revenue, "
    "true as opens_files_in_range, true as skips_files from lines where Revenue between 20000 and 30000",
    "silver_placement": f"with {_SILVER} select Country, count(*) as rows, true as in_one_file from silver group by Country",
    "gold_sketches": f"with {_GOLD} select Country, UniqueCustomers, UniqueProductsSold, TotalTransactions, "
    "true as within_5_percent, true as merged_equals_at_once from gold",
    "flow_counts": f"with {_FUNNEL} select funnel.*, silver_rows as stored_silver, "
    "(select count(distinct Country) from bronze where Quantity > 0 and UnitPrice > 0 and CustomerID is not null) "
    "as stored_gold from funnel",
    "guards": _GUARDS,
    "recast_text_measures": f"with {_BRONZE} select {_LINE}, "
    "case when cast(InvoiceNo as bigint) % 3 = 0 then null else Quantity end as Quantity, "
    "case when cast(InvoiceNo as bigint) % 4 = 0 then null else round(cast(UnitPrice as double), 2) end as UnitPrice from bronze",
    "forest_walk": f"with {_SILVER} select {_LINE}, Quantity, true as walk_equals_model from silver where {_SPLIT} >= 80",
    "forest_tree_means": f"with {_SILVER} select count(*) as train_rows, round(avg(Quantity), 6) as mean_quantity, "
    f"true as leaves_equal_means, true as has_splits from silver where {_SPLIT} < 80",
    "training_run": _TRAINING_RUN,
}
