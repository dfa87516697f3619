"""Queries of the regular grid (problem 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidentia.operators.regular_grid import missing_days, regular_grid
from evidentia.sources.tables import table


def p4_found(spark, sf_dir):
    return missing_days(regular_grid(table(spark, sf_dir, "tension")))


def p4_grid(spark, sf_dir):
    return regular_grid(table(spark, sf_dir, "tension")).withColumn("on_date", F.date_format("on_date", "yyyy-MM-dd"))


_P4 = r"""
with r as (select series_id, parse_ok, navy_ships, official_ships, regexp_replace(date, '\s', '', 'g') t from tension),
 s as (select *, case when regexp_full_match(t, '\d{3,4}[-/.]\d{1,2}[-/.]\d{1,2}') then string_split_regex(t, '[-/.]')
                      when regexp_full_match(t, '\d{7,8}') then [t[:-5], t[-4:-3], t[-2:]] end p from r),
 d as (select *, try_cast((case when length(p[1]) = 3 then p[1]::int + 1911 else p[1]::int end) || '-' || lpad(p[2], 2, '0') || '-' || lpad(p[3], 2, '0') as date) as dy from s where p is not null),
 g as (select series_id, unnest(generate_series(min(dy), max(dy), interval 1 day))::date as dy from d where dy is not null group by series_id),
 f as (select * from g, (values ('navy_ships'), ('official_ships')) v(field))
select f.series_id, f.field, strftime(f.dy, '%Y-%m-%d') as on_date from f
 where not exists (select 1 from d where d.series_id is not distinct from f.series_id and d.dy = f.dy and d.parse_ok
                    and (case f.field when 'navy_ships' then d.navy_ships else d.official_ships end) >= 0)
"""

QUERIES = {"p4_found": p4_found, "p4_grid": p4_grid}
ORACLE = {"p4_found": _P4}
