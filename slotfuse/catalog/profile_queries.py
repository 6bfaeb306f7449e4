"""Projections, counts, pivots and statistics over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotfuse.catalog.registry import query, rounded, table
from slotfuse.functions.answers import list_items
from slotfuse.functions.timeslots import minutes_between
from slotfuse.operators import profile
from slotfuse.operators.conform import conform, lower_names, parse_readings, rename
from slotfuse.operators.curves import KEY_DIGITS, PRIME, bootstrap_band, density_curve, poisson_limits, replicate_constants

# The codes that occur in `orders`.
STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("select c_name, c_custkey, c_acctbal from customer")
def project_columns(spark, sf_dir):
    """Choose, reorder and drop columns."""
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_name", "c_custkey", "c_nationkey", "c_acctbal").drop("c_nationkey")


@query(
    """select c_custkey as student_id, c_name as name, c_nationkey as form_room,
    c_acctbal, c_mktsegment from customer"""
)
def rename_lowercase(spark, sf_dir):
    """Rename by map, then all names to lower case."""
    customer = table(spark, sf_dir, "customer")
    named = rename(customer, {"c_custkey": "Student_Id", "c_name": "Name", "c_nationkey": "Form_Room"})
    return lower_names(named)


@query(
    """select try_cast(o_orderkey as integer) as O_orderkey, try_cast(o_orderpriority as integer) as O_orderpriority,
    cast(trunc(o_totalprice) as integer) as O_totalprice, cast(o_custkey as varchar) as O_custkey from orders"""
)
def conform_schema(spark, sf_dir):
    """Declared types and names; what does not fit is NULL, other columns go."""
    declared = T.StructType(
        [
            T.StructField("O_orderkey", T.IntegerType()),
            T.StructField("O_orderpriority", T.IntegerType()),
            T.StructField("O_totalprice", T.IntegerType()),
            T.StructField("O_custkey", T.StringType()),
        ]
    )
    return conform(table(spark, sf_dir, "orders"), declared)




@query(
    r"""select page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) as double) as value,
    cast('2024-01-' || substr(cast(page_id + 100 as varchar), 2, 2) || ' 00:00:00' as timestamp) as time
    from pages where regexp_extract(url, '/([0-9]+)', 1) <> ''
    and try_cast('2024-01-' || substr(cast(page_id + 100 as varchar), 2, 2) as date) is not null"""
)
def tolerant_parse(spark, sf_dir):
    """Text parsed as number and time; rows where either fails are dropped."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "/([0-9]+)", 1).alias("value"),
        F.concat(
            F.lit("2024-01-"),
            F.substring((F.col("page_id") + 100).cast("string"), 2, 2),
            F.lit(" 00:00:00"),
        ).alias("time"),
    )
    return parse_readings(pages, "value", "time", "timestamp_ntz")


@query(
    r"""select page_id, try_cast(regexp_extract(url, '/([0-9]+)', 1) as integer) as url_key,
    regexp_extract(url, '//([^/]+)', 1) as host from pages"""
)
def regexp_key(spark, sf_dir):
    """regexp_extract: keys taken out of a path, NULL where there is none."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "/([0-9]+)", 1).try_cast("int").alias("url_key"),
        F.regexp_extract("url", "//([^/]+)", 1).alias("host"),
    )


@query("select count(*) as count from orders")
def row_count(spark, sf_dir):
    """A1."""
    return profile.row_count(table(spark, sf_dir, "orders"))


@query('select o_orderpriority, count(*) as "Total" from orders group by 1')
def group_count(spark, sf_dir):
    """A4: rows per group, renamed."""
    return profile.group_count(table(spark, sf_dir, "orders"), "o_orderpriority", name="Total")


@query('select o_custkey, count(*) as "Total" from orders group by 1 order by 2 desc, 1')
def sort_desc_count(spark, sf_dir):
    """O1: groups by falling count."""
    counts = profile.group_count(table(spark, sf_dir, "orders"), "o_custkey", name="Total")
    return counts.orderBy(F.desc("Total"), "o_custkey")


@query("select o_orderstatus, o_orderpriority, count(*) as count from orders group by 1,2")
def two_key_count(spark, sf_dir):
    """A7."""
    return profile.group_count(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


def _sql_pivot(rows: str, columns: str, values: list[str]) -> str:
    cells = ", ".join(
        f"nullif(count(*) filter (where {columns}='{v}'), 0) as \"{v}\"" for v in values
    )
    return f"select {rows}, {cells} from orders group by 1"


@query(_sql_pivot("o_orderpriority", "o_orderstatus", STATUSES))
def pivot_count(spark, sf_dir):
    """A count matrix, empty cells NULL."""
    return profile.pivot_counts(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query(_sql_pivot("o_orderpriority", "o_orderstatus", STATUSES))
def crosstab(spark, sf_dir):
    """The matrix of an already grouped table."""
    counts = profile.group_count(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    return profile.pivot_grouped(counts, "o_orderpriority", "o_orderstatus", "count")


@query(_sql_pivot("o_orderstatus", "o_orderpriority", PRIORITIES))
def pivot_transposed(spark, sf_dir):
    """A10: the matrix with rows and columns exchanged."""
    return profile.pivot_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("select count(distinct o_custkey) as customers from orders")
def distinct_count(spark, sf_dir):
    """A15."""
    return profile.distinct_count(table(spark, sf_dir, "orders"), "o_custkey", "customers")


@query(
    """select l_returnflag, round(avg(minutes),6) as average, max(minutes) as maximum, min(minutes) as minimum
    from (select l_returnflag, round((epoch(l_shipdate)-epoch(o_orderdate))/60.0, 1) as minutes
          from orders join lineitem on o_orderkey=l_orderkey) group by 1"""
)
def class_duration_stats(spark, sf_dir):
    """Average, longest and shortest duration in minutes per kind."""
    spans = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    minutes = minutes_between(F.col("o_orderdate"), F.col("l_shipdate"))
    names = {"avg": "average", "max": "maximum", "min": "minimum"}
    return rounded(profile.spread_stats(spans, "l_returnflag", minutes, names), ["average"])


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " union all ".join(
        f"""select '{a}' as "column", """
        + ", ".join(
            f"1.0::double as {b}" if a == b else f"round(corr({a},{b}),6) as {b}" for b in _MEASURES
        )
        + " from lineitem"
        for a in _MEASURES
    )
)
def corr_matrix(spark, sf_dir):
    """Pearson matrix."""
    return rounded(profile.correlation_matrix(table(spark, sf_dir, "lineitem"), _MEASURES), _MEASURES)


@query("select item, count(*) as \"Total\" from (select unnest(string_split(p_name,' ')) as item from part) group by 1")
def explode_list_count(spark, sf_dir):
    """split, explode: items of a list column counted."""
    items = table(spark, sf_dir, "part").select(list_items("p_name", " ").alias("item"))
    return profile.group_count(items, "item", name="Total")


@query(
    """with ends as (select min(value) as lo, max(value) as hi from events),
    placed as (select cast(least(floor((value-lo)/(hi-lo)*12), 11) as int) as bin from events, ends),
    counted as (select bin, count(*) as n from placed group by 1)
    select cast(b.range as int) as bin, round(lo + b.range*((hi-lo)/12),6) as "from",
    round(lo + (b.range+1)*((hi-lo)/12),6) as "to", coalesce(n,0) as count
    from range(12) b cross join ends left join counted on bin=b.range"""
)
def histogram12(spark, sf_dir):
    """Twelve bins of equal width."""
    return rounded(profile.histogram(table(spark, sf_dir, "events"), "value", 12), ["from", "to"])


_REPLICATES = 100
_SQL_REPLICATES = ", ".join(f"({r}, {a}, {b})" for r, (a, b) in enumerate(map(replicate_constants, range(_REPLICATES))))
_SQL_WEIGHT = " + ".join(f"(u >= {limit})::int" for limit in poisson_limits())


@query(
    f"""with rows as (select hour(ts)::int as hour, value,
        cast('0x' || substr(md5(cast(event_id as varchar)), 1, {KEY_DIGITS}) as bigint) as key from events where value is not null),
    drawn as (select hour, value, r, (key * a + b) % {PRIME} as u
        from rows, (values {_SQL_REPLICATES}) c(r, a, b)),
    sums as (select hour, r, sum(({_SQL_WEIGHT}) * value) / nullif(sum({_SQL_WEIGHT}), 0) as m from drawn group by 1, 2)
    select s.hour, round(any_value(p.mean), 6) as mean, round(quantile_cont(m, 0.025), 6) as lower, round(quantile_cont(m, 0.975), 6) as upper
    from sums s join (select hour, avg(value) as mean from rows group by 1) p on s.hour = p.hour group by s.hour"""
)
def hourly_bootstrap_band(spark, sf_dir):
    """The mean of each hour with the band that a plot bootstraps around it."""
    events = table(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("hour"), "value")
    return rounded(bootstrap_band(events, "hour", "value", ["event_id"], _REPLICATES), ["mean", "lower", "upper"])


@query(
    """with f as (select min(value) as lo, max(value) as hi, count(value) as n, stddev_samp(value) as s,
        (max(value) - min(value)) / 127 as step from events),
    placed as (select (value - lo) / step as x, least(floor((value - lo) / step), 126) as low from events, f where value is not null),
    halves as (select low as own, 1 - (x - low) as mass from placed union all select low + 1, x - low from placed),
    grid as (select own, sum(mass) as mass from halves group by 1),
    width as (select s * pow(n, -0.2) as h from f)
    select cast(p.range as int) as point, round(lo + p.range * step, 6) as x,
    round(sum(mass * exp(-0.5 * pow((p.range - own) * step / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) as density
    from range(128) p, grid, f, width group by p.range, lo, step"""
)
def density_of_values(spark, sf_dir):
    """The density curve over the histogram."""
    return rounded(density_curve(table(spark, sf_dir, "events"), "value"), ["x", "density"])
