"""Inputs of queries whose tables lack something, as SQL that Spark and DuckDB both read.

Pages have no fetch day, there are no dated URL lists, and conversations quote nobody. The
views add these to the given rows, by arithmetic on their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:@]+)', 2))"

VIEWS = {
    "captures": (
        ["pages"],
        """
select page_id, url, html,
  cast('2024-01-01' as date) + cast(page_id * 7919 % 360 as int) fetched
from {pages}""",
    ),
    # Every host is put on up to three lists, most are taken off again, some twice; entries
    # repeat, and every fifth host has its parent domain on a list instead.
    "list_entries": (
        ["pages"],
        f"""
select 'list' || cast(k % 3 as string) list,
  case when no % 5 = 0 then regexp_replace(host, '^[^.]+[.]', '') else host end domain,
  cast('2024-01-01' as date) + cast(case k when 0 then no % 200 when 1 then no * 7 % 250
    when 2 then no * 3 % 300 when 3 then no % 200 + no % 90 when 4 then no * 7 % 250 + no % 60
    when 5 then no * 3 % 300 + no % 2 else no % 200 + 100 + no % 40 end as int) as day,
  k not in (3, 4, 5) listed
from (select host, no, {{eight}} k
  from (select {_HOST} host, min(page_id) no from {{pages}} group by 1) h
  where host <> '') q
where (no + k) % 4 <> 1""",
    ),
    # Every answer quotes the message before, and that one's quote of the one before it.
    "mails": (
        ["conversations"],
        """
select c.conv_id, c.turn, c.role,
  case when two.text is null then '' else '>> ' || replace(two.text, chr(10), chr(10) || '> > ')
    || chr(10) end
  || case when one.text is null then '' else '> ' || replace(one.text, chr(10), chr(10) || '> ')
    || chr(10) || chr(10) end
  || c.text as text
from {conversations} c
left join (select conv_id, turn, min(text) text from {conversations} group by 1, 2) one
  on one.conv_id = c.conv_id and one.turn = c.turn - 1 - c.turn % 3 % 2 and c.turn % 5 <> 4
left join (select conv_id, turn, min(text) text from {conversations} group by 1, 2) two
  on two.conv_id = c.conv_id and two.turn = c.turn - 2 and c.turn % 5 <> 4""",
    ),
}
_EIGHT = {"spark": "explode(sequence(0, 7))", "duckdb": "unnest(range(0, 8))"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bases, sql = VIEWS[name]
    tables = {base: spark.read.parquet(f"{sf_dir}/{base}.parquet") for base in bases}
    return spark.sql(sql.replace("{eight}", _EIGHT["spark"]), **tables)


def cte(*names: str) -> str:
    """The views as common table expressions over the registered tables."""
    parts = []
    for name in names:
        bases, sql = VIEWS[name]
        text = sql.format(eight=_EIGHT["duckdb"], **{b: b for b in bases})
        parts.append(f"{name} as ({text})")
    return ",\n".join(parts)
