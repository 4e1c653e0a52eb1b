"""The suite's queries in plain SQL, for another engine to run on the same tables."""

from __future__ import annotations

from tagledger.schemas import FACT_COLUMNS, SILVER_COLUMNS, STAGING_COLUMNS
from tagledger.suite.queries import CALENDAR, PAGE_LIMIT, SHOP

K = "cast(regexp_extract(props, '[0-9]+') as int)"

EVENTS = f"""
bronze as (
  select 'item ' || user_id as product_name, '/item/' || user_id as product_url,
         value as current_price, cast(null as double) as mrp, {K} as discount_pct,
         cast(user_id % 6 as double) as rating, event_type as category, 'events' as source,
         ts as scraped_at
  from events)"""

DIRTY = f"""
bronze as (
  select case event_type when 'error' then null when 'click' then ''
              when 'view' then 'item ' || user_id else 'item ' || user_id || chr(9) end as product_name,
         '/item/' || user_id as product_url,
         case when event_type = 'signup' then null
              when event_type = 'purchase' and {K} = 50 then -5
              when event_type = 'purchase' and {K} = 51 then cast('NaN' as double)
              else value end as current_price,
         case when event_type = 'purchase' then 999.5::double end as mrp,
         case when event_type in ('click', 'view') then null else {K} end as discount_pct,
         case when event_type = 'view' then null else cast(user_id % 6 as double) end as rating,
         event_type as category, 'events' as source,
         case when event_type = 'click' then null else ts end as scraped_at
  from events)"""

PARTS = """
items as (
  select *, floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 as price,
         cast(round(l_discount * 100) as int) as pct
  from lineitem join part on l_partkey = p_partkey)"""

LINEITEM = (
    PARTS
    + """,
bronze as (
  select p_name as product_name, '/part/' || l_partkey as product_url, price as current_price,
         cast(null as double) as mrp, pct as discount_pct, l_quantity / 10 as rating,
         p_type as category, cast(l_suppkey as varchar) as source, l_shipdate as scraped_at
  from items)"""
)

VALID = "product_name is not null and current_price > 0"

ENRICHED = f"""
enriched as (
  select md5(lower(trim(product_name, ' ')) || coalesce('||' || category, '')) as product_id,
         product_name, split_part(product_name, ' ', 1) as brand, product_url, category, current_price,
         coalesce(mrp, current_price) as mrp, coalesce(discount_pct, 0) as discount_pct,
         coalesce(discount_pct > 0, false) as has_discount, rating,
         coalesce(rating > 0, false) as is_rating_available, source, scraped_at,
         cast(scraped_at as date) as run_date
  from bronze where {VALID})"""

_REST = [c for c in SILVER_COLUMNS if c not in ("product_id", "scraped_at", "run_hour")]
DEDUPED = (
    ENRICHED
    + f""",
silver as (
  select * exclude (rn), '06' as run_hour from (
    select *, row_number() over (partition by product_id, scraped_at
             order by {', '.join(c + ' nulls first' for c in _REST)}) as rn,
           count(*) over (partition by product_id, scraped_at) as copies
    from enriched) where rn = 1)"""
)

_SILVER = ", ".join(SILVER_COLUMNS)
_STAGING = ", ".join(STAGING_COLUMNS)

DIMS = """
cats as (
  select cast(row_number() over (order by category_name nulls last) as bigint) as category_key, category_name
  from (select distinct category as category_name from silver)),
plats as (
  select cast(row_number() over (order by platform_name nulls last) as bigint) as platform_key, platform_name
  from (select distinct source as platform_name from silver))"""


def _calendar(first: str, days: int | str) -> str:
    return f"""
digits as (select unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) as d),
numbers as (
  select a.d + 10 * b.d + 100 * c.d + 1000 * e.d as n
  from digits a cross join digits b cross join digits c cross join digits e),
spine as (select cast({first} + cast(n as int) as date) as day from numbers where n < {days}),
calendar as (select cast(strftime(day, '%Y%m%d') as int) as date_key, day as full_date from spine)"""


_EVENT_DAYS = _calendar(f"date '{CALENDAR[0]}'", CALENDAR[1])
_HISTORY = "scraped_at nulls last, run_date nulls last, run_hour nulls last, current_price nulls last"
_SEQUENCE = "run_date nulls last, product_key nulls last, scraped_at nulls last, run_hour nulls last, current_price nulls last"

JOINED = """
joined as (
  select product_id as product_key, category_key, platform_key, date_key, current_price, mrp, discount_pct,
         has_discount, rating, is_rating_available, scraped_at, run_date, run_hour
  from silver left join cats on category = category_name
       left join plats on source = platform_name left join calendar on run_date = full_date)"""

TREND = f"""
trend as (
  select *, current_price - previous_price as price_change from (
    select *, lag(current_price) over (partition by product_key order by {_HISTORY}) as previous_price
    from joined))"""

FACT = f"""
fact as (
  select cast(row_number() over (order by {_SEQUENCE}) as bigint) as snapshot_id, * from trend)"""

_FACT_COLUMNS = ", ".join(FACT_COLUMNS)

MRP = "case when price <> 0 and {pct} <> 0 and {pct} <> 100 then floor(price / (1 - {pct} / 100.0::double) * 100 + 0.5) / 100 end"


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f')"


def _metrics(bronze: str) -> str:
    return _with(bronze, DEDUPED) + f"""
select (select count(*) from bronze) as raw_rows,
       (select count(*) from bronze where {VALID}) as valid_rows,
       (select count(*) from bronze where ({VALID}) is not true) as invalid_rows,
       (select count(*) from silver) as deduped_rows"""


LISTING = (
    PARTS
    + f""",
records as (
  select cast(l_orderkey as varchar) as category, l_linenumber as page_num, {_iso('l_shipdate')} as scraped_at,
         p_name || ' &Co' as product_name, '{SHOP}/part/' || l_partkey || '?a=1&b=2' as product_url,
         price as current_price, {MRP.format(pct='pct')} as mrp, case when pct > 0 then pct end as discount_pct,
         l_quantity / 10 as rating
  from items where l_returnflag <> 'N')"""
)
CUT = (
    LISTING
    + """,
per_page as (
  select cast(l_orderkey as varchar) as category, l_linenumber as page_num,
         sum(case when l_returnflag <> 'N' then 1 else 0 end) as n
  from items where l_linenumber <= 4 group by all),
ends as (select category, min(page_num) as first_empty from per_page where n = 0 group by category),
kept as (
  select records.* from records left join ends on records.category = ends.category
  where page_num <= 4 and (first_empty is null or page_num < first_empty))"""
)


def _check(test: str, tbl: str, column: str, failures: str) -> str:
    return (
        f"select '{test}' as test, '{tbl}' as \"table\", '{column}' as \"column\", failures, "
        f"failures = 0 as passed from (select cast(({failures}) as bigint) as failures)"
    )


def _report() -> str:
    source = {
        "staging": ("silver", {}),
        "dim_category": ("cats", {}),
        "dim_platform": ("plats", {}),
        "dim_date": ("calendar", {}),
        "dim_product": ("products", {}),
        "fact_price_snapshots": ("fact", {}),
    }
    keys = {
        "dim_date": "date_key",
        "dim_category": "category_key",
        "dim_platform": "platform_key",
        "dim_product": "product_key",
        "fact_price_snapshots": "snapshot_id",
    }
    parents = {
        "product_key": "dim_product",
        "category_key": "dim_category",
        "platform_key": "dim_platform",
        "date_key": "dim_date",
    }
    not_null = [("staging", "product_id"), ("staging", "current_price"), *keys.items()]
    not_null += [("fact_price_snapshots", c) for c in (*parents, "current_price")]
    out = [_check("empty", "staging", "mrp", "select count(*) from silver where mrp < 0")]
    for tbl, c in keys.items():
        out.append(
            _check("unique", tbl, c,
                   f"select count(*) from (select {c} from {source[tbl][0]} where {c} is not null "
                   f"group by {c} having count(*) > 1)")
        )
    for tbl, c in not_null:
        out.append(_check("not_null", tbl, c, f"select count(*) from {source[tbl][0]} where {c} is null"))
    for c, parent in parents.items():
        out.append(
            _check("relationship", "fact_price_snapshots", c,
                   f"select count(*) from fact where {c} is not null and {c} not in "
                   f"(select {c} from {source[parent][0]} where {c} is not null)")
        )
    return "\nunion all\n".join(out)


def _lag(bronze: str) -> str:
    return _with(bronze, DEDUPED) + f"""
select product_key, scraped_at, current_price, previous_price, current_price - previous_price as price_change
from (select product_id as product_key, scraped_at, current_price,
             lag(current_price) over (partition by product_id order by {_HISTORY}) as previous_price
      from silver)"""


def _fact(bronze: str) -> str:
    return _with(bronze, DEDUPED, DIMS, _EVENT_DAYS, JOINED, TREND, FACT) + f"select {_FACT_COLUMNS} from fact"


_SLOT_ROWS = _SILVER.replace("run_date", "date '2024-01-01' as run_date")

ORACLES: dict[str, str] = {
    "silver_typed": _with(DIRTY) + "select * from bronze",
    "silver_valid": _with(DIRTY) + f"select * from bronze where {VALID}",
    "silver_metrics": _metrics(DIRTY),
    "silver_metrics_lineitem": _metrics(LINEITEM),
    "silver_product_id": _with(LINEITEM) + """
select product_url, product_name, c as category,
       md5(lower(trim(product_name, ' ')) || coalesce('||' || c, '')) as product_id
from (select *, case when category <> 'PROMO' then category end as c from bronze)""",
    "silver_enriched": _with(LINEITEM, ENRICHED) + "select * from enriched",
    "silver_dedupe": _with(LINEITEM, DEDUPED) + "select * exclude (run_hour) from silver",
    "silver_full": _with(EVENTS, DEDUPED) + f"select {_SILVER} from silver",
    "silver_full_dirty": _with(DIRTY, DEDUPED) + f"select {_SILVER} from silver",
    "silver_full_lineitem": _with(LINEITEM, DEDUPED) + f"select {_SILVER} from silver",
    "staging_projection": _with(EVENTS, DEDUPED) + f"select {_STAGING} from silver",
    "dim_category": _with(LINEITEM, DEDUPED, DIMS) + "select * from cats",
    "dim_platform": _with(LINEITEM, DEDUPED, DIMS) + "select *, platform_name as platform_url from plats",
    "dim_product": _with(LINEITEM, DEDUPED) + """
select product_id as product_key, product_name, brand, category, product_url from (
  select *, row_number() over (partition by product_id
           order by scraped_at desc nulls first, run_date desc nulls last, run_hour desc nulls last,
                    product_name desc nulls last, brand desc nulls last, category desc nulls last,
                    product_url desc nulls last) as r
  from silver) where r = 1""",
    "dim_date": _with(
        "limits as (select min(cast(l_shipdate as date)) as lo, max(cast(l_shipdate as date)) as hi from lineitem)",
        _calendar("(select lo from limits)", "(select hi - lo + 1 from limits)"),
    )
    + """
select cast(strftime(day, '%Y%m%d') as int) as date_key, day as full_date,
       cast(extract(day from day) as int) as day_of_month, rpad(dayname(day), 9, ' ') as day_name,
       cast(extract(dow from day) as int) as day_of_week, cast(extract(week from day) as int) as week_number,
       cast(extract(month from day) as int) as month, rpad(monthname(day), 9, ' ') as month_name,
       cast(extract(quarter from day) as int) as quarter, cast(extract(year from day) as int) as year,
       extract(dow from day) in (0, 6) as is_weekend
from spine""",
    "number_spine": """
with digits as (select unnest([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) as d),
numbers as (
  select cast(a.d + 10 * b.d + 100 * c.d + 1000 * e.d + 10000 * f.d + 100000 * g.d as bigint) as n
  from digits a cross join digits b cross join digits c cross join digits e cross join digits f cross join digits g)
select n, count(event_id) as n_events from numbers left join events on n = user_id
where n <= (select max(user_id) from events) group by n""",
    "fact_star_join": _with(EVENTS, DEDUPED, DIMS, _EVENT_DAYS, JOINED) + "select * from joined",
    "fact_price_trend": _lag(LINEITEM),
    "fact_price_trend_hot": _lag(LINEITEM),
    "fact_snapshot_id": _with(LINEITEM, DEDUPED) + f"""
select cast(row_number() over (order by {_SEQUENCE}) as bigint) as snapshot_id, *
from (select product_id as product_key, scraped_at, run_date, run_hour, current_price from silver)""",
    "fact_price_snapshots": _fact(EVENTS),
    "fact_price_snapshots_lineitem": _fact(LINEITEM),
    "fact_price_snapshots_hot": _fact(EVENTS),
    "parse_money": """
select l_orderkey, l_linenumber, l_partkey,
       try_cast(trim(replace(replace(' ' || format('₹{:,.2f}', l_extendedprice) || ' ', '₹', ''), ',', '')) as double) as price
from lineitem""",
    "parse_discount": f"""
select event_id, case when event_type not in ('error', 'view') then {K} end as discount_pct from events""",
    "parse_rating": """
select event_id, case when event_type <> 'error' then cast(user_id % 6 as double) + 0.25 end as rating from events""",
    "mrp_from_discount": _with(PARTS) + f"""
select l_orderkey, l_linenumber, l_partkey, price, pct, {MRP.format(pct='pct')} as mrp,
       {MRP.format(pct='(pct * 10)')} as mrp_tenfold, {MRP.format(pct='(pct * 12)')} as mrp_twelvefold
from items""",
    "page_cards": f"""
with links as (
  select page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) as link from pages),
fields as (
  select page_id, regexp_extract(link, '>([^<]*)</a>', 1) as name, regexp_extract(link, 'href="([^"]*)"', 1) as href
  from links),
decoded as (
  select page_id, regexp_replace(replace(name, '&quot;', '"'), '&amp;?', '&', 'g') as product_name,
         regexp_replace(replace(href, '&quot;', '"'), '&amp;?', '&', 'g') as href
  from fields)
select page_id, product_name, case when starts_with(href, '/') then '{SHOP}' || href else href end as product_url
from decoded""",
    "page_urls": f"""
select page_id, url as absolute,
       case when starts_with(path, '/') then '{SHOP}' || path else path end as relative, '' as missing
from (select page_id, url, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) as path from pages)""",
    "page_cut": f"""
with numbered as (
  select page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) as category,
         cast((length(html) - length(replace(html, '<b>', ''))) / 3 as bigint) as n_records from pages),
paged as (select *, row_number() over (partition by category order by page_id) as page_num from numbered),
ends as (select category, min(page_num) as first_empty from paged where n_records = 0 and page_num <= {PAGE_LIMIT} group by 1)
select page_id, paged.category, page_num, n_records from paged left join ends on paged.category = ends.category
where page_num <= {PAGE_LIMIT} and (first_empty is null or page_num < first_empty)""",
    "page_cut_both": """
with numbered as (
  select page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) || '-' || (page_id % 12) as category,
         greatest(cast((length(html) - length(replace(html, '<li>', ''))) / 4 as bigint) - 5, 0) as n_records from pages),
paged as (select *, row_number() over (partition by category order by page_id) as page_num from numbered),
ends as (select category, min(page_num) as first_empty from paged where n_records = 0 and page_num <= 4 group by 1)
select page_id, paged.category, page_num, n_records from paged left join ends on paged.category = ends.category
where page_num <= 4 and (first_empty is null or page_num < first_empty)""",
    "listing_pages_parsed": _with(CUT) + """
select per_page.category, page_num, cast(n as bigint) as n_records
from per_page left join ends on per_page.category = ends.category
where first_empty is null or page_num <= first_empty""",
    "listing_damaged": _with(PARTS) + f"""
, cards as (
  select l_orderkey || '-' || l_partkey as category, l_linenumber as page_num, {_iso('l_shipdate')} as scraped_at,
         l_linenumber % 7 as kind, pct, p_name,
         case l_linenumber % 7 when 1 then 'NaN'::double when 2 then 1e17::double else price end as price
  from items where l_linenumber % 7 not in (3, 6))
select category, page_num, scraped_at,
       case kind when 5 then 'Ü«&bogus;' || chr(65533) || '&amp; ' || p_name else p_name end as product_name,
       case kind when 0 then '' when 4 then '{SHOP}/p' when 5 then '{SHOP}/p?a&b' else 'https://o/p' end as product_url,
       price as current_price,
       case when pct > 0 then case when kind in (1, 2) then price / (1 - pct / 100.0::double)
            else floor(price / (1 - pct / 100.0::double) * 100 + 0.5) / 100 end end as mrp,
       case when pct > 0 then pct end as discount_pct, cast(null as double) as rating
from cards""",
    "listing_records": _with(LISTING) + "select * from records",
    "listing_bronze": _with(CUT) + "select * exclude (page_num), 'shop' as source from kept",
    "check_unique": """
select count(*) as failures, 'line' as "column" from (
  select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all
select count(*), 'o_orderkey' from (select 1 from orders group by o_orderkey having count(*) > 1)""",
    "check_not_null": _with(DIRTY) + "\nunion all\n".join(
        f"select '{c}' as \"column\", count(*) as failures from bronze where {c} is null"
        for c in ("product_name", "current_price", "mrp", "discount_pct", "scraped_at")
    ),
    "check_relationship": """
select count(*) as failures from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'F')""",
    "check_negative_mrp": _with(PARTS) + f"""
select count(*) as failures from items where {MRP.format(pct='(pct * 12)')} < 0""",
    "check_report": _with(
        EVENTS, DEDUPED, DIMS, _EVENT_DAYS, JOINED, TREND, FACT,
        "products as (select distinct product_id as product_key from silver)",
    ) + _report(),
    "bronze_roundtrip": f"""
select case event_type when 'error' then null when 'click' then ''
            when 'view' then '  item ' || user_id || ' ' else 'item ' || user_id || chr(9) end as product_name,
       '/item/' || user_id as product_url,
       case when event_type = 'signup' then 'Rs ' || value
            when event_type = 'purchase' and {K} = 50 then '-5'
            when event_type = 'purchase' and {K} = 51 then 'NaN' else cast(value as varchar) end as current_price,
       case event_type when 'click' then '' when 'purchase' then '999.5' end as mrp,
       case event_type when 'purchase' then {K} || '.5' when 'click' then 'none' when 'view' then null
            else cast({K} as varchar) end as discount_pct,
       case when event_type = 'view' then 'n/a' else cast(user_id % 6 as varchar) end as rating,
       event_type as category, 'events' as source,
       case when event_type = 'click' then 'zz' else {_iso('ts')} end as scraped_at
from events""",
    "slot_replace": _with(EVENTS, DEDUPED) + f"""
select {_SLOT_ROWS} from silver
union all
select {_SLOT_ROWS.replace('run_hour', "'18' as run_hour")} from silver""",
    "slot_load": _with(DIRTY, DEDUPED) + f"""
select {_SLOT_ROWS}, (select count(*) from silver) as deduped_rows,
       (select count(*) from bronze where ({VALID}) is not true) as invalid_rows,
       (select count(*) from bronze) as raw_rows, (select count(*) from bronze where {VALID}) as valid_rows,
       (select count(*) from silver where run_date is distinct from date '2024-01-01') as off_slot_rows
from silver""",
    "slot_load_invalid": _with(EVENTS, DEDUPED) + f"""
select {_SLOT_ROWS}, cast(0 as bigint) as deduped_rows, n as invalid_rows, n as raw_rows, cast(0 as bigint) as valid_rows,
       cast(0 as bigint) as off_slot_rows
from silver, (select count(*) as n from events where event_type in ('signup', 'error'))""",
    "slot_switch": _with(EVENTS, DEDUPED) + f"""
select {_SLOT_ROWS}, (select count(*) from silver) as deduped_rows, cast(0 as bigint) as invalid_rows,
       (select count(*) from bronze) as raw_rows, (select count(*) from bronze) as valid_rows,
       (select count(*) from silver where run_date is distinct from date '2024-01-01') as off_slot_rows
from silver""",
    "register_partitions": _with(EVENTS, DEDUPED) + """
select category, date '2024-01-01' as run_date, run_hour, count(*) as n_rows from silver group by all""",
    "materialize_full_refresh": _with(EVENTS, DEDUPED) + f"select {_STAGING} from silver",
    "slot_run_fact": _with(
        EVENTS,
        DEDUPED.replace("silver as (", "loaded as ("),
        """silver as (
  select * replace (date '2024-01-01' as run_date,
                    case when extract(hour from scraped_at) < 12 then '06' else '18' end as run_hour)
  from loaded)""",
        DIMS,
        _calendar("date '2023-12-26'", 40),
        JOINED,
        TREND,
        FACT,
    ) + f"select {_FACT_COLUMNS} from fact",
    "pages_to_silver": _with(
        CUT,
        """bronze as (
  select * exclude (category, page_num, scraped_at), 'parts' as category, 'shop' as source,
         cast(scraped_at as timestamp) as scraped_at from kept)""",
        DEDUPED,
    ) + f"select {_SILVER} from silver",
}
ORACLES["bronze_forms"] = ORACLES["bronze_roundtrip"]
