"""Shared SQL of the oracle side: shop rows computed flat, without nested documents."""

from orderlake.checks.shop import TABLES, texts

_T = texts(**{t: t for t in TABLES})

_DOCS = f"docs as ({_T['documents']})"

# Documents with an `entries` array: all but pending orders without lines.
_KEPT = "kept as (select * from docs where l_linenumber is not null or o_orderstatus <> 'P')"

# Entries of the given documents: the product line, its service line, or one row of nulls.
_ENTRIES = """entries as (
  select *, cast(l_linenumber as bigint) as entry_number, 'P' || cast(l_partkey as varchar) as product,
         l_extendedprice as price, cast(null as bigint) as parent_number, false as service
  from {source} where l_linenumber is not null
  union all
  select *, cast(l_linenumber + 100 as bigint), 'S' || cast(l_suppkey as varchar),
         l_extendedprice * 0.5::double, cast(l_linenumber as bigint), true
  from {source} where l_returnflag = 'R'
  union all
  select *, null, null, null, null, null from {source} where l_linenumber is null
)"""

_PROMOTIONS = """promotions as (
  select code, event_ts, cast(null as varchar) as consumed, cast(null as varchar) as promotion
  from kept where o_orderpriority in ('1-URGENT', '2-HIGH')
  union all
  select code, event_ts, cast(l_linenumber as varchar) || '|' || cast(l_linenumber + 100 as varchar),
         'P' || l_linestatus from kept where o_orderpriority = '3-MEDIUM'
  union all
  select code, event_ts, null, 'Q' || l_returnflag from kept where o_orderpriority = '3-MEDIUM'
  union all
  select code, event_ts, '', 'C' || l_returnflag from kept where o_orderpriority = '4-NOT SPECIFIED'
  union all
  select code, event_ts, cast(l_linenumber as varchar) || '|', null
  from kept where o_orderpriority = '4-NOT SPECIFIED'
  union all
  select code, event_ts, null, null from kept where o_orderpriority = '4-NOT SPECIFIED'
  union all
  select code, event_ts, cast(l_linenumber as varchar), 'P' || l_returnflag
  from kept where o_orderpriority = '5-LOW'
  union all
  select code, event_ts, cast(l_linenumber as varchar), 'P' || l_linestatus
  from kept where o_orderpriority = '5-LOW'
  union all
  select code, event_ts, 'abc', 'X' from kept where o_orderpriority = '5-LOW'
  union all
  select code, event_ts, cast(l_linenumber as varchar), null
  from kept where o_orderpriority = '5-LOW'
),
pieces as (
  select code, event_ts, promotion,
         unnest(coalesce(string_split(consumed, '|'), [cast(null as varchar)])) as entry_text
  from promotions
),
by_entry as (
  select code, event_ts, try_cast(entry_text as bigint) as entry_number,
         coalesce(array_to_string(list_sort(list(promotion) filter (promotion is not null)), '|'), '')
           as promotion_code
  from pieces where entry_text <> '' or entry_text is null group by 1, 2, 3
),
carts as (
  select code, coalesce(array_to_string(list_sort(list(distinct promotion)
           filter (promotion is not null)), '|'), '') as cart_promotions
  from pieces where entry_text = '' or (entry_text is null and promotion is not null) group by 1
)"""

DOCS = f"with {_DOCS} "
PROMOTIONS = f"with {_DOCS}, {_KEPT}, {_PROMOTIONS} "
DOC_ENTRIES = f"with {_DOCS}, {_ENTRIES.format(source='docs')} "
KEPT_ENTRIES = f"with {_DOCS}, {_KEPT}, {_ENTRIES.format(source='kept')}, {_PROMOTIONS} "
LOOKUPS = f"with rates as ({_T['rates']}), consumers as ({_T['consumers']})"
FACT = f"{LOOKUPS}, docs as ({_T['documents']}), silver as ({_T['silver']}) "
SILVER = f"with silver as ({_T['silver']}) "


def moment(expression: str) -> str:
    """Timestamp as `yyyy-MM-dd HH:mm:ss` text, null as the empty text."""
    return f"coalesce(strftime({expression}, '%Y-%m-%d %H:%M:%S'), '')"


def epoch_text(expression: str) -> str:
    return f"'/Date(' || cast(epoch_ms({expression}) as varchar) || ')/'"
