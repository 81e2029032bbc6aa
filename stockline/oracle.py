"""The catalogue's queries as DuckDB SQL over the same tables.

Periods, groups, horizons and column names are written out here and not taken
from the package, so that a wrong one there shows.
"""

from __future__ import annotations

from dataclasses import dataclass

START_DEV, START_OOT, END = "1995-07-01", "2001-10-01", "2001-11-04"
QUANTITY, SOLD = "TotalQtySale", "label"
TRAILING_GROUPS = {
    "mc": ("MaterialCode",),
    "br": ("BranchCode",),
    "mc_dow": ("MaterialCode", "DayOfWeek"),
    "mc_pv": ("MaterialCode", "ProvinceEN"),
    "mc_ds": ("MaterialCode", "DistrictEN"),
    "cat_lv2": ("product_cat_lv2",),
    "cat_lv2_pv": ("product_cat_lv2", "ProvinceEN"),
    "cat_lv2_ds": ("product_cat_lv2", "DistrictEN"),
    "cat_lv2_dow": ("product_cat_lv2", "DayOfWeek"),
    "cat_lv2_br": ("product_cat_lv2", "BranchCode"),
}
RECENCY_GROUPS = {
    "mc_br": ("MaterialCode", "BranchCode"),
    "mc_ds": ("MaterialCode", "DistrictEN"),
    "cat_lv2_ds": ("product_cat_lv2", "DistrictEN"),
    "cat_lv2_br": ("product_cat_lv2", "BranchCode"),
}
GRAINS = {
    "prediction_avg": ("BranchCode", "MaterialCode"),
    "prediction_avg_dow": ("BranchCode", "MaterialCode", "DayOfWeek"),
    "prediction_avg_month": ("BranchCode", "MaterialCode", "Month"),
    "prediction_avg_all_store": ("MaterialCode",),
    "prediction_avg_dow_all_store": ("MaterialCode", "DayOfWeek"),
    "prediction_avg_month_all_store": ("MaterialCode", "Month"),
}


@dataclass(frozen=True)
class Trailing:
    name: str
    group_cols: tuple[str, ...]
    measures = ("TotalQtySale", "TotalNetSale")
    horizons = (60, 90, 180)
    ratios = ((90, 180),)
    lag = 5

    def column(self, m: str, stat: str, days: int, inc0: bool = False) -> str:
        return f"{m}_{stat}_{days}d_{self.name}{'_inc0' if inc0 else ''}"

    def ratio_column(self, m: str, a: int, b: int) -> str:
        return f"{m}_sum_ratio_{a}d{b}d_{self.name}"

    def columns(self) -> list[str]:
        pairs = [(m, d) for m in self.measures for d in self.horizons]
        return [self.column(m, "sum", d) for m, d in pairs] + [
            self.column(m, stat, d, flag) for m, d in pairs for stat in ("avg", "stddev", "cv")
            for flag in (False, True)] + [self.ratio_column(m, 90, 180) for m in self.measures]


@dataclass(frozen=True)
class Recency:
    name: str
    group_cols: tuple[str, ...]
    horizons = (60, 90, 180)
    lag = 5
    longest = 90

    @property
    def run_column(self) -> str:
        return f"zero_consc_{self.name}"

    def max_column(self, days: int) -> str:
        return f"zero_consc_max_{days}d_{self.name}"

    def columns(self) -> list[str]:
        return [self.run_column, *[self.max_column(d) for d in self.horizons]]


KEYS = "OrderKey, LineNumber, MaterialCode, BranchCode"

PLACES = """
places AS (
  SELECT s_suppkey AS BranchCode, s_nationkey AS ZipCode, n_name AS ProvinceEN, r_name AS DistrictEN
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

ITEMS = """
items AS (
  SELECT p_partkey AS MaterialCode, p_retailprice AS supPrice, p_brand AS product_cat_lv2,
         CASE WHEN CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) <= 20
              THEN 'group_' || (CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 4)
              ELSE 'others' END AS product_cat_lv1
  FROM part)"""

SALES = """
base AS (
  SELECT l_orderkey AS OrderKey, l_linenumber AS LineNumber, l_partkey AS MaterialCode, l_suppkey AS BranchCode,
         CAST(l_shipdate AS DATE) AS "Date", last_day(CAST(l_shipdate AS DATE)) AS Date_EOM,
         l_quantity AS TotalQtySale,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)) AS TotalNetSale,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label,
         l_extendedprice / l_quantity AS avgPrice,
         l_extendedprice / l_quantity * (1 - l_discount) AS avgPriceDis,
         CASE WHEN l_returnflag = 'N' THEN 'NORMAL'
              ELSE 'RF_' || l_returnflag || '|LS_' || l_linestatus END AS types
  FROM lineitem)"""

CALENDAR = """CAST(dayofyear("Date") AS INTEGER) AS Yearday, CAST(month("Date") AS INTEGER) AS Month,
  CAST(dayofweek("Date") + 1 AS INTEGER) AS DayOfWeek, CAST(day("Date") AS INTEGER) AS DayOfMonth,
  CAST(year("Date") AS INTEGER) AS Year, CAST(quarter("Date") AS INTEGER) AS Quarter,
  CAST(weekofyear("Date") AS INTEGER) AS WeekOfYear, CAST(ceil(month("Date") / 3.0) AS BIGINT) AS MonthQuarter"""

FULL = f"""{SALES},{PLACES},{ITEMS},
sales AS (
  SELECT base.*, ZipCode, ProvinceEN, DistrictEN, supPrice, product_cat_lv2, product_cat_lv1, {CALENDAR}
  FROM base LEFT JOIN places USING (BranchCode) LEFT JOIN items USING (MaterialCode))"""

HOLES = """
holes AS (
  SELECT OrderKey, LineNumber, MaterialCode, BranchCode, "Date",
         CASE WHEN LineNumber % 3 <> 0 THEN TotalQtySale END AS TotalQtySale,
         CASE WHEN LineNumber % 2 <> 0 THEN types END AS types
  FROM sales)"""

SPLIT = f"""
train AS (SELECT * FROM sales WHERE "Date" < DATE '{START_OOT}'),
test AS (SELECT * FROM sales WHERE "Date" >= DATE '{START_OOT}')"""


def rnd(expression: str, digits: int = 6) -> str:
    scale = f"1{'0' * digits}.0"
    return f"floor(({expression}) * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({scale} AS DOUBLE)"


def quoted(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def trailing_ctes(group: Trailing, source: str = "sales") -> str:
    """Group-day rows to ``stats`` with every column of the grouping set."""
    g = quoted(group.group_cols)
    windows = ", ".join(
        f'w{d} AS (PARTITION BY {g} ORDER BY "Date" RANGE BETWEEN INTERVAL {d + group.lag + 1} DAY PRECEDING '
        f"AND INTERVAL {group.lag + 1} DAY PRECEDING)" for d in group.horizons)
    pairs = [(m, d) for m in group.measures for d in group.horizons]
    sums = [f"CAST(sum({m}) OVER w{d} AS DOUBLE) AS {group.column(m, 'sum', d)}" for m, d in pairs]
    sums += [f"CAST(sum({k}) OVER w{d} AS BIGINT) AS {k}_sum_{d}d" for d in group.horizons for k in ("label", "count")]
    avgs = []
    for m, d in pairs:
        total = group.column(m, "sum", d)
        avgs.append(f"{total} / nullif(count_sum_{d}d, 0) AS {group.column(m, 'avg', d)}")
        avgs.append(f"{total} / nullif(label_sum_{d}d, 0) AS {group.column(m, 'avg', d, True)}")
    gaps = []
    for m, d in pairs:
        actual = f"CAST({m} AS DOUBLE)"
        gaps.append(f"pow({actual} - {group.column(m, 'avg', d, True)}, 2) AS every_{m}_{d}")
        gaps.append(f"CASE WHEN label = 1 THEN pow({actual} - {group.column(m, 'avg', d)}, 2) ELSE 0 END "
                    f"AS single_{m}_{d}")
    roots = []
    for m, d in pairs:
        roots.append(f"sqrt(sum(every_{m}_{d}) OVER w{d} / nullif(count_sum_{d}d, 0)) "
                     f"AS {group.column(m, 'stddev', d, True)}")
        roots.append(f"sqrt(sum(single_{m}_{d}) OVER w{d} / nullif(label_sum_{d}d, 0)) "
                     f"AS {group.column(m, 'stddev', d)}")
    last = []
    for m, d in pairs:
        for flag in (False, True):
            last.append(f"{group.column(m, 'stddev', d, flag)} / nullif({group.column(m, 'avg', d, flag)}, 0) "
                        f"AS {group.column(m, 'cv', d, flag)}")
    for m in group.measures:
        for a, b in group.ratios:
            last.append(f"{group.column(m, 'sum', a)} / nullif({group.column(m, 'sum', b)}, 0) "
                        f"AS {group.ratio_column(m, a, b)}")
    totals = ", ".join(f"sum({m}) AS {m}" for m in group.measures)
    return f"""
daily AS (
  SELECT {g}, "Date", {totals}, CAST(sum(label) AS BIGINT) AS label, count(label) AS count
  FROM {source} GROUP BY ALL),
sums AS (SELECT *, {', '.join(sums)} FROM daily WINDOW {windows}),
avgs AS (SELECT *, {', '.join(avgs)} FROM sums),
gaps AS (SELECT *, {', '.join(gaps)} FROM avgs),
devs AS (SELECT *, {', '.join(roots)} FROM gaps WINDOW {windows}),
stats AS (SELECT *, {', '.join(last)} FROM devs)"""


def rounded_stats(group: Trailing, columns=None) -> str:
    parts = []
    for c in columns or group.columns():
        digits = 3 if "_stddev_" in c else 6
        parts.append(f"{rnd(c, digits)} AS {c}")
    return ", ".join(parts)


def trailing_sql(group: Trailing, columns=None, where: str = "") -> str:
    return (f'WITH {FULL},{trailing_ctes(group)} SELECT {quoted(group.group_cols)}, "Date", '
            f"{rounded_stats(group, columns)} FROM stats {where}")


def recency_ctes(group: Recency) -> str:
    g = quoted(group.group_cols)

    def frame(first: int) -> str:
        return (f'(PARTITION BY {g} ORDER BY "Date" RANGE BETWEEN INTERVAL {first} DAY PRECEDING '
                f"AND INTERVAL {group.lag + 1} DAY PRECEDING)")

    longest = ", ".join(
        f"max({group.run_column}) OVER {frame(d + group.lag + 1)} AS {group.max_column(d)}" for d in group.horizons)
    return f"""
flags AS (SELECT {g}, "Date", max(label) AS label FROM sales GROUP BY ALL),
lasts AS (SELECT *, max(CASE WHEN label = 1 THEN "Date" END) OVER {frame(group.longest + group.lag)}
          AS last_sell_date FROM flags),
runs AS (SELECT *, CAST(coalesce(datediff('day', last_sell_date, "Date") - {group.lag}, {group.longest}) AS INTEGER)
         AS {group.run_column} FROM lasts),
longest AS (SELECT *, {longest} FROM runs)"""


def recency_sql(group: Recency, columns=None) -> str:
    return (f'WITH {FULL},{recency_ctes(group)} SELECT {quoted(group.group_cols)}, "Date", '
            f"{quoted(columns or group.columns())} FROM longest")


def cut_ctes(counts: str) -> str:
    return f"""{FULL}, counts AS ({counts}),
cum AS (SELECT code, n, CAST(sum(n) OVER (ORDER BY n DESC, code ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumsum,
               CAST(sum(n) OVER () AS BIGINT) AS total FROM counts)"""


def cut_sql(counts: str, cutoff: float, digits: int) -> str:
    return f"""WITH {cut_ctes(counts)}
SELECT code, n, cumsum, {rnd('cumsum / total', digits)} AS share FROM cum WHERE cumsum / total <= {cutoff}"""


def flag_sql(code: str) -> str:
    return f"CAST(CASE WHEN list_contains(string_split(types, '|'), '{code}') THEN 1 ELSE 0 END AS INTEGER)"


def predicted_ctes(value: str) -> str:
    return f"""{FULL},{SPLIT},
predicted AS (
  SELECT test.*, a.p AS prediction FROM test
  JOIN (SELECT MaterialCode, avg({value}) AS p FROM train GROUP BY 1) a USING (MaterialCode)
  JOIN (SELECT MaterialCode, DayOfWeek, avg({value}) AS q FROM train GROUP BY 1, 2) b USING (MaterialCode, DayOfWeek)),
yp AS (SELECT CAST({value} AS DOUBLE) AS y, prediction AS p FROM predicted)"""


LOG_ERROR = "CASE WHEN p + 1 > 0 AND y + 1 > 0 THEN pow(ln(p + 1) - ln(y + 1), 2) END"


def metric_sql(value: str, measures: dict[str, str]) -> str:
    columns = ", ".join(f"{rnd(e)} AS {name}" for name, e in measures.items())
    return f"WITH {predicted_ctes(value)} SELECT {columns} FROM yp"


def lat_long_ctes() -> str:
    return f"""
positions AS (
  SELECT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS ZipCode, n_name AS ProvinceEN,
         CAST(c_custkey % 180 AS DOUBLE) AS latitude, CAST(c_custkey % 360 AS DOUBLE) AS longitude
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
zips AS (SELECT ZipCode, avg(latitude) AS lat, avg(longitude) AS lon FROM positions GROUP BY 1),
provinces AS (SELECT ProvinceEN, avg(latitude) AS plat, avg(longitude) AS plon FROM positions GROUP BY 1),
located AS (
  SELECT sales.*, {rnd('coalesce(lat, plat)')} AS latitude, {rnd('coalesce(lon, plon)')} AS longitude
  FROM sales LEFT JOIN zips USING (ZipCode) LEFT JOIN provinces USING (ProvinceEN))"""


STORES = """
stores AS (
  SELECT s_suppkey AS BranchCode, CAST(1990 + s_suppkey % 20 AS INTEGER) AS YearOpened,
         CAST(1 + s_suppkey % 12 AS INTEGER) AS MonthOpened, 'cluster_' || (s_nationkey % 5) AS LocationCluster,
         CASE WHEN s_acctbal < 5000 THEN 'small' ELSE 'large' END AS StoreType
  FROM supplier WHERE s_acctbal >= 0)"""

TRAILING = {n: Trailing(n, g) for n, g in TRAILING_GROUPS.items()}
RECENCY = {n: Recency(n, g) for n, g in RECENCY_GROUPS.items()}
BRAND, PLACE, RUNS = TRAILING["cat_lv2"], TRAILING["cat_lv2_pv"], RECENCY["cat_lv2_br"]


def named(group: Trailing, stat: str, kinds: tuple[bool, ...]) -> list[str]:
    return [group.column(m, stat, d, k) for m in group.measures for d in group.horizons for k in kinds]


def feature_sql() -> dict[str, str]:
    g, b = quoted(PLACE.group_cols), quoted(BRAND.group_cols)
    sums = ", ".join(BRAND.column(m, "sum", d) for m in BRAND.measures for d in BRAND.horizons)
    counts = ", ".join(f"{k}_sum_{d}d" for d in BRAND.horizons for k in ("label", "count"))
    out = {
        "group_day_rollup": f"""WITH {FULL},{trailing_ctes(PLACE)}
            SELECT {g}, "Date", CAST(TotalQtySale AS DOUBLE) AS TotalQtySale,
            CAST(TotalNetSale AS DOUBLE) AS TotalNetSale, label, count FROM daily""",
        "trailing_sum": f'WITH {FULL},{trailing_ctes(BRAND)} SELECT {b}, "Date", {sums} FROM stats',
        "trailing_counts": f'WITH {FULL},{trailing_ctes(BRAND)} SELECT {b}, "Date", {counts} FROM stats',
        "trailing_avg": trailing_sql(PLACE, named(PLACE, "avg", (False, True))),
        "trailing_stddev_inc0": trailing_sql(PLACE, named(PLACE, "stddev", (True,))),
        "trailing_stddev": trailing_sql(PLACE, named(PLACE, "stddev", (False,))),
        "trailing_cv": trailing_sql(PLACE, named(PLACE, "cv", (False, True))),
        "sum_ratio": trailing_sql(PLACE, [PLACE.ratio_column(m, x, y) for m in PLACE.measures for x, y in PLACE.ratios]),
    }
    for group in TRAILING.values():
        out[f"ts_agg_{group.name}"] = trailing_sql(group)
    mc = TRAILING["mc"]
    out["ts_agg_mc_rows"] = f"""WITH {FULL},{trailing_ctes(mc)}
        SELECT {KEYS}, "Date", Date_EOM, {rounded_stats(mc)}
        FROM sales LEFT JOIN (SELECT MaterialCode, "Date", {quoted(mc.columns())} FROM stats) s
        USING (MaterialCode, "Date")"""
    out["ts_agg_scoring_day"] = trailing_sql(
        BRAND, where=f"WHERE \"Date\" BETWEEN DATE '{START_OOT}' AND DATE '{END}'")
    r = quoted(RUNS.group_cols)
    out |= {
        "group_day_flag": f'WITH {FULL},{recency_ctes(RUNS)} SELECT {r}, "Date", label FROM flags',
        "last_sell_date": f'WITH {FULL},{recency_ctes(RUNS)} SELECT {r}, "Date", label, last_sell_date FROM lasts',
        "zero_consc": recency_sql(RUNS, [RUNS.run_column]),
        "zero_consc_max": recency_sql(RUNS, RUNS.columns()[1:]),
    }
    for runs in RECENCY.values():
        out[f"consc_{runs.name}"] = recency_sql(runs)
    ds = RECENCY["mc_ds"]
    out["consc_mc_ds_rows"] = f"""WITH {FULL},{recency_ctes(ds)}
        SELECT {KEYS}, "Date", Date_EOM, {quoted(ds.columns())}
        FROM sales LEFT JOIN (SELECT MaterialCode, DistrictEN, "Date", {quoted(ds.columns())} FROM longest) s
        USING (MaterialCode, DistrictEN, "Date")"""
    return out


def cleaning_sql() -> dict[str, str]:
    bounds = f"DATE '{START_DEV}'", f"DATE '{START_OOT}'", f"DATE '{END}'"
    dev, oot, end = (f"last_day({b})" for b in bounds)
    return {
        "project_rename": "SELECT l_partkey AS item, l_suppkey AS store, l_quantity AS quantity FROM lineitem",
        "cast_types": """WITH text AS (
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_linenumber = 3 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
              CASE WHEN l_linenumber = 3 THEN '' ELSE CAST(l_quantity AS VARCHAR) END AS flag,
              CASE WHEN l_linenumber = 3 THEN 'unknown' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS day
            FROM lineitem)
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRY_CAST(quantity AS DOUBLE) AS quantity,
              CAST(TRY_CAST(flag AS DOUBLE) AS INTEGER) AS flag, TRY_CAST(day AS DATE) AS day FROM text""",
        "dropna_all": f"""WITH {FULL},{HOLES} SELECT TotalQtySale, types FROM holes
            WHERE TotalQtySale IS NOT NULL OR types IS NOT NULL""",
        "dropna_any": f"""WITH {FULL},{HOLES} SELECT * FROM holes
            WHERE TotalQtySale IS NOT NULL AND types IS NOT NULL""",
        "fillna_mixed": f"""WITH {FULL},{HOLES} SELECT {KEYS}, "Date",
            coalesce(TotalQtySale, 0) AS TotalQtySale, coalesce(types, 'others') AS types FROM holes""",
        "nan_to_null": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber <> 2 THEN l_quantity END AS quantity FROM lineitem""",
        "null_audit": f"""WITH {FULL},{HOLES} SELECT
            count(*) - count(OrderKey) AS OrderKey, count(*) - count(LineNumber) AS LineNumber,
            count(*) - count(MaterialCode) AS MaterialCode, count(*) - count(BranchCode) AS BranchCode,
            count(*) - count("Date") AS "Date", count(*) - count(TotalQtySale) AS TotalQtySale,
            count(*) - count(types) AS types FROM holes""",
        "clean_province": f"WITH {PLACES} SELECT * FROM places",
        "sold_label": f"""WITH {FULL},{HOLES} SELECT {KEYS}, "Date",
            CASE WHEN TotalQtySale > 25 THEN 1 ELSE 0 END AS label FROM holes""",
        "month_end": f'WITH {FULL} SELECT {KEYS}, "Date", Date_EOM FROM sales',
        "time_split": f"""WITH {FULL} SELECT {KEYS}, "Date",
            CASE WHEN "Date" < DATE '{START_OOT}' THEN 'train' ELSE 'test' END AS part FROM sales""",
        "oot_split": f"""WITH {FULL} SELECT {KEYS}, "Date", Date_EOM,
            CASE WHEN Date_EOM < {oot} THEN 'dev' ELSE 'oot' END AS part
            FROM sales WHERE Date_EOM BETWEEN {dev} AND {end}""",
        "pruned_range": f"""WITH {FULL} SELECT {KEYS}, "Date", Date_EOM, TotalQtySale FROM sales
            WHERE "Date" BETWEEN DATE '1998-03-10' AND DATE '1999-02-20'""",
        "extract_date": f'WITH {FULL} SELECT {KEYS}, "Date", {CALENDAR} FROM base',
        "month_shift": """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
            SELECT o_orderkey, day, last_day(day + INTERVAL 3 MONTH) AS three_months_on,
              last_day(day - INTERVAL 14 MONTH) AS fourteen_months_back,
              CAST(day - INTERVAL 7 DAY AS DATE) AS week_before FROM o""",
        "month_calendar": f"""WITH {FULL}, b AS (SELECT date_trunc('month', min("Date")) AS a,
            date_trunc('month', max("Date")) AS z FROM base)
            SELECT last_day(CAST(m AS DATE)) AS Date_EOM
            FROM (SELECT unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS m FROM b)""",
    }


def dimension_sql() -> dict[str, str]:
    flags = ", ".join(f"{flag_sql(c)} AS {c}" for c in ("RF_A", "RF_R", "LS_F", "LS_O"))
    frequent = ", ".join(f"CAST(CASE WHEN list_contains(codes, '{c}') THEN {flag_sql(c)} ELSE 0 END AS INTEGER) AS {c}"
                         for c in ("RF_A", "RF_R", "LS_F", "LS_O"))
    split_codes = "SELECT unnest(string_split(types, '|')) AS code FROM base"
    codes = f"SELECT code, count(*) AS n FROM ({split_codes}) WHERE code <> 'NORMAL' GROUP BY 1"
    items = "SELECT MaterialCode AS code, count(*) AS n FROM base GROUP BY 1"
    price = f"{rnd('avgPrice - supPrice')} AS revenue, {rnd('avgPrice - avgPriceDis')} AS discount, " \
            f"{rnd('100 * ((avgPrice - avgPriceDis) / nullif(avgPrice, 0))')} AS percentage_discount"
    return {
        "location_join": f'WITH {FULL} SELECT {KEYS}, "Date", ZipCode, ProvinceEN, DistrictEN FROM sales',
        "lat_long": f'WITH {FULL},{lat_long_ctes()} SELECT {KEYS}, "Date", Date_EOM, latitude, longitude FROM located',
        "category_join": f'WITH {FULL} SELECT {KEYS}, "Date", product_cat_lv1, product_cat_lv2 FROM sales',
        "store_cluster": f"""WITH {FULL},{STORES} SELECT {KEYS}, "Date", YearOpened, MonthOpened,
            LocationCluster, StoreType FROM sales LEFT JOIN stores USING (BranchCode)""",
        "discount_feature": f'WITH {FULL} SELECT {KEYS}, "Date", {price} FROM sales',
        "promo_codes": f"WITH {FULL} SELECT code FROM ({codes})",
        "promo_onehot": f'WITH {FULL} SELECT {KEYS}, "Date", {flags} FROM base',
        "freq_cut_onehot": cut_sql(codes, 0.8, 6),
        "freq_cut_categorical": cut_sql(items, 0.99, 9),
        "cumsum_share": f"""WITH {FULL}, counts AS ({items})
            SELECT code, n, CAST(sum(n) OVER (ORDER BY n DESC) AS BIGINT) AS cumsum FROM counts""",
        "sort_desc": f"""WITH {FULL} SELECT BranchCode AS code, count(*) AS n FROM base GROUP BY 1
            ORDER BY n DESC, code""",
        "basic_features": f"""WITH {cut_ctes(codes)},{lat_long_ctes()},
            kept AS (SELECT list(code) AS codes FROM cum WHERE cumsum / total <= 0.8),{STORES}
            SELECT {KEYS}, "Date", Date_EOM, TotalQtySale, CAST(TotalNetSale AS DOUBLE) AS TotalNetSale, label,
              {rnd('avgPrice')} AS avgPrice, {rnd('avgPriceDis')} AS avgPriceDis, {rnd('supPrice')} AS supPrice,
              ZipCode, ProvinceEN, DistrictEN, {CALENDAR}, product_cat_lv2, product_cat_lv1,
              {frequent}, latitude, longitude,
              YearOpened, MonthOpened, LocationCluster, StoreType, {price}
            FROM located LEFT JOIN stores USING (BranchCode) CROSS JOIN kept""",
    }


def average_sql() -> dict[str, str]:
    keys = {
        "avg_store_item": "prediction_avg",
        "avg_store_item_dow": "prediction_avg_dow",
        "avg_store_item_month": "prediction_avg_month",
        "avg_item": "prediction_avg_all_store",
        "avg_item_dow": "prediction_avg_dow_all_store",
        "avg_item_month": "prediction_avg_month_all_store",
    }
    out = {}
    for key, name in keys.items():
        cols = ", ".join(GRAINS[name])
        out[key] = f"""WITH {FULL},{SPLIT} SELECT {cols}, {rnd('avg(TotalQtySale)')} AS {name}
            FROM train GROUP BY {cols}"""
    sets = ", ".join(f"({', '.join(grain)})" for grain in GRAINS.values())
    finest = "BranchCode, MaterialCode, DayOfWeek, Month"
    out["baseline_grouping_sets"] = f"""WITH {FULL},{SPLIT}
        SELECT {finest}, CAST(grouping({finest}) AS BIGINT) AS grain, {rnd('avg(TotalQtySale)')} AS average
        FROM train GROUP BY GROUPING SETS ({sets})"""
    for key, name in (("baseline_item_avg", "prediction_avg_all_store"),
                      ("baseline_dow_avg", "prediction_avg_dow_all_store")):
        cols = ", ".join(GRAINS[name])
        out[key] = f"""WITH {FULL},{SPLIT},
            a AS (SELECT {cols}, avg(TotalQtySale) AS p FROM train GROUP BY {cols})
            SELECT {KEYS}, "Date", DayOfWeek, TotalQtySale, {rnd('p')} AS {name}
            FROM test LEFT JOIN a USING ({cols})"""
    missed, rows, sold = "count(*) FILTER (p < y)", "count(*)", "nullif(count(*) FILTER (y > 0), 0)"
    rmsle = f"sqrt(avg({LOG_ERROR}))"
    short = "sum(greatest(y - p, 0)) / sum(y)"
    out["eval_metrics"] = metric_sql(QUANTITY, {
        "rmse": "sqrt(avg(pow(p - y, 2)))",
        "mse": "avg(pow(p - y, 2))",
        "r2": "1 - avg(pow(p - y, 2)) / var_pop(y)",
        "mae": "avg(abs(p - y))",
        "mape": "avg(100 * abs(p - y) / nullif(y, 0))",
        "rmsle": rmsle,
        "accuracy": f"100 - (exp({rmsle}) - 1) * 100",
        "percent_oos": f"100 * {missed} / {rows}",
        "percent_oos_sale": f"100 * {missed} / {sold}",
        "percent_sales_oos": short,
    })
    out["oos_metrics"] = metric_sql(SOLD, {
        "percent_oos": f"100 * {missed} / {rows}",
        "percent_oos_sold": f"100 * count(*) FILTER (p < y AND y <> 0) / {rows}",
        "percent_oos_sale": f"100 * {missed} / {sold}",
        "percent_sales_oos": short,
    })
    out["mape_zero_safe"] = metric_sql(SOLD, {
        "mape_zero_safe": "100 * avg(abs(CASE WHEN y <> 0 THEN abs(y - p) / y "
                          "ELSE p / (SELECT avg(y) FROM yp) END))"})
    out["smape"] = metric_sql(SOLD, {"smape": "avg(100 * abs(p - y) / nullif((p + y) / 2, 0))"})
    return out


def full_sql() -> str:
    """Each group's statistics on their own, joined to the fact one after another."""
    doubles = ["avgPriceDis", "avgPrice", "supPrice"]
    plain = ["DayOfMonth", "DayOfWeek", "Quarter", "MonthQuarter", "Month", "WeekOfYear", "YearOpened", "MonthOpened",
             "LocationCluster", "StoreType", "ProvinceEN", "DistrictEN", "product_cat_lv1", "product_cat_lv2",
             "latitude", "longitude"]
    price = {"revenue": "avgPrice - supPrice", "discount": "avgPrice - avgPriceDis",
             "percentage_discount": "100 * ((avgPrice - avgPriceDis) / nullif(avgPrice, 0))"}
    flags = [f"{flag_sql(c)} AS {c}" for c in ("RF_A", "RF_R", "LS_F", "LS_O")]
    joins, columns = [], []
    for n, group in enumerate([*TRAILING.values(), *RECENCY.values()]):
        g = quoted(group.group_cols)
        trailing = isinstance(group, Trailing)
        body = (f"WITH {trailing_ctes(group)} SELECT {g}, \"Date\", {rounded_stats(group)} FROM stats" if trailing
                else f"WITH {recency_ctes(group)} SELECT {g}, \"Date\", {quoted(group.columns())} FROM longest")
        joins.append(f'LEFT JOIN ({body}) t{n} USING ({g}, "Date")')
        columns += group.columns()
    basic = [f"{rnd(c)} AS {c}" for c in doubles] + [f"{rnd(e)} AS {c}" for c, e in price.items()] + plain + flags
    return f"""WITH {FULL},{lat_long_ctes()},{STORES}
SELECT {KEYS}, "Date", Date_EOM, located.TotalQtySale, {', '.join(basic)}, {', '.join(columns)}
FROM located LEFT JOIN stores USING (BranchCode) {' '.join(joins)}"""


def store_sql() -> dict[str, str]:
    days = """days AS (SELECT product_cat_lv2, "Date", sum(TotalQtySale) AS TotalQtySale,
        last_day("Date") AS Date_EOM FROM sales GROUP BY 1, 2)"""
    full_row = f'{KEYS}, "Date"'
    return {
        "fs_roundtrip": f"""WITH {FULL}, {days} SELECT * FROM days
            WHERE "Date" BETWEEN DATE '1996-02-10' AND DATE '2000-06-20'""",
        "fs_replace_month": f"""WITH {FULL}, {days} SELECT product_cat_lv2, "Date", Date_EOM,
            CASE WHEN Date_EOM = DATE '1998-05-31' THEN -TotalQtySale ELSE TotalQtySale END AS TotalQtySale FROM days""",
        "fs_second_period": f"""WITH {FULL}, {days} SELECT * FROM days
            WHERE "Date" BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'""",
        "fs_replace_empty_month": f"""WITH {FULL} SELECT {full_row}, Date_EOM, TotalQtySale FROM base
            WHERE "Date" BETWEEN DATE '1997-01-01' AND DATE '1997-06-30' AND month("Date") <> 2""",
        "fs_missing_months": f"""WITH {FULL} SELECT DISTINCT Date_EOM FROM base
            WHERE month("Date") IN (2, 7) AND year("Date") > 1996""",
        "combine_features": f"""WITH {FULL},{lat_long_ctes()},{trailing_ctes(BRAND)},{recency_ctes(RUNS)}
            SELECT {KEYS}, "Date", Date_EOM, product_cat_lv2, l.TotalQtySale, latitude, longitude,
              {rounded_stats(BRAND)}, {quoted(RUNS.columns())}
            FROM located l
            LEFT JOIN (SELECT product_cat_lv2, "Date", {quoted(BRAND.columns())} FROM stats) s
              USING (product_cat_lv2, "Date")
            LEFT JOIN (SELECT product_cat_lv2, BranchCode, "Date", {quoted(RUNS.columns())} FROM longest) r
              USING (product_cat_lv2, BranchCode, "Date")""",
        "full_features": full_sql(),
        "key_uniqueness": f"""WITH {FULL} SELECT OrderKey, LineNumber, count(*) AS n FROM base
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "scoring_day_rows": f"""WITH {FULL} SELECT {full_row}, TotalQtySale FROM base
            UNION ALL SELECT {KEYS}, DATE '2001-10-27', CAST(NULL AS DOUBLE) FROM base
            WHERE "Date" = DATE '2001-10-20'""",
        "csv_scan": f"""WITH {FULL} SELECT CAST(BranchCode AS VARCHAR) AS BranchCode,
            CAST(MaterialCode AS VARCHAR) AS MaterialCode, "Date", TotalQtySale, types FROM base""",
        "csv_quarantine": f"""WITH {FULL}, lines AS (SELECT *, concat_ws(',', OrderKey, LineNumber, BranchCode, MaterialCode,
              CASE WHEN LineNumber IN (2, 4) THEN 'soon' ELSE strftime("Date", '%Y-%m-%d') END,
              CASE WHEN LineNumber = 4 THEN 'x' ELSE CAST(label AS VARCHAR) END,
              CASE WHEN LineNumber = 3 THEN 'more' END) AS line FROM base)
            SELECT OrderKey, LineNumber, CAST(BranchCode AS VARCHAR) AS BranchCode, CAST(MaterialCode AS VARCHAR) AS MaterialCode,
              "Date", label, NULL AS line, NULL AS reason FROM lines WHERE LineNumber NOT BETWEEN 2 AND 5
            UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, line,
              CASE LineNumber WHEN 2 THEN 'Date' WHEN 3 THEN 'fields' WHEN 4 THEN 'Date,label' ELSE 'header' END
            FROM lines WHERE LineNumber BETWEEN 2 AND 5""",
        "stratified_split": f"""WITH {FULL} SELECT {full_row}, label,
            CASE WHEN CAST('0x' || substr(md5(concat_ws('|', 42, label, OrderKey, LineNumber, MaterialCode, BranchCode,
              strftime("Date", '%Y-%m-%d'))), 1, 8) AS BIGINT) < round(0.3 * 4294967296)
            THEN 'sample' ELSE 'rest' END AS part FROM base""",
        "score_two_days": " UNION ALL ".join(f"""(WITH {FULL} SELECT {call} AS call, {KEYS},
            DATE '{day}' AS "Date", TRUE AS predicted FROM base
            WHERE "Date" = DATE '{day}' OR "Date" = DATE '{day}' - 7)"""
            for call, day in enumerate(("2001-10-20", "2001-10-27", "2001-11-01"), 1)),
        "months_to_write": f"""WITH {FULL}, months AS (
            SELECT DISTINCT Date_EOM FROM base WHERE "Date" BETWEEN DATE '1997-01-01' AND DATE '1997-08-31'),
            modes AS (SELECT unnest(['', 'overwrite', 'soft_overwrite']) AS mode)
            SELECT 'absent' AS name, mode, Date_EOM FROM modes, months
            UNION ALL SELECT 'brand_days', mode, Date_EOM FROM modes, months
            WHERE mode = 'overwrite' OR mode = 'soft_overwrite' AND month(Date_EOM) >= 5""",
        "csv_strings": f"""WITH {FULL} SELECT CAST(OrderKey AS VARCHAR) AS OrderKey, CAST(LineNumber AS VARCHAR) AS LineNumber,
            CAST(MaterialCode AS VARCHAR) AS MaterialCode, CAST(BranchCode AS VARCHAR) AS BranchCode,
            strftime("Date", '%Y-%m-%d') AS "Date", CAST(label AS VARCHAR) AS label, types FROM base""",
        "overwritten_table": f"""WITH {FULL} SELECT OrderKey, LineNumber, TotalQtySale, Date_EOM,
            (SELECT count(*) FROM base) AS first_rows, (SELECT count(*) FROM base WHERE label = 1) AS second_rows
            FROM base WHERE label = 1""",
        "csv_report": f"""WITH {FULL} SELECT types AS code, count(*) AS n FROM base GROUP BY 1""",
        "category_files": """SELECT CAST(p_partkey AS VARCHAR) AS MaterialCode, p_brand AS product_cat_lv2,
            CASE WHEN CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) <= 20
                 THEN 'group_' || (CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) % 4) END AS product_cat_lv1
            FROM part""",
        "named_flags": f"""WITH {FULL} SELECT {full_row}, {flag_sql('LS_F')} AS LS_F, {flag_sql('LS_O')} AS LS_O FROM base""",
        "row_ids": f"""WITH {FULL} SELECT count(*) AS n, count(*) AS numbers FROM base""",
        "random_parts": f"""WITH {FULL} SELECT {full_row}, TRUE AS near FROM base""",
        "anti_remainder": f"""WITH {FULL} SELECT {full_row}, label FROM base WHERE label <> 1""",
    }


DENSITY = """WITH RECURSIVE
p AS MATERIALIZED (
  SELECT l_partkey AS id, round(avg(l_quantity) / 50, 9) AS x, round(avg(l_discount) * 10, 9) AS y FROM lineitem GROUP BY 1),
e AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM p a JOIN p b
  ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.01),
core AS MATERIALIZED (SELECT a AS id FROM e GROUP BY a HAVING count(*) >= 5),
ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id, id AS label FROM core UNION SELECT ce.b, reach.label FROM reach JOIN ce ON ce.a = reach.id),
comp AS (SELECT id, min(label) AS component FROM reach GROUP BY 1),
border AS (
  SELECT e.a AS id, min(component) AS component FROM e JOIN comp ON e.b = comp.id
  WHERE e.a NOT IN (SELECT id FROM core) GROUP BY 1),
clustered AS (SELECT * FROM comp UNION ALL SELECT * FROM border)"""


def density_sql() -> dict[str, str]:
    return {
        "pairwise_distance": """WITH gaps AS (
            SELECT a.vec_id AS id, unnest(CAST(a.embedding AS DOUBLE[])) - unnest(CAST(b.embedding AS DOUBLE[])) AS g
            FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
            SELECT id, round(sqrt(sum(g * g)), 5) AS euclidian, round(sum(abs(g)), 5) AS manhattan,
            round(sum(g * g), 5) AS fast_euclidian FROM gaps GROUP BY id""",
        "eps_neighbors": f"{DENSITY} SELECT a AS id, b AS other FROM e WHERE a NOT IN (SELECT id FROM core)",
        "core_points": f"{DENSITY} SELECT id FROM core",
        "dbscan_clusters": f"{DENSITY} SELECT id AS point, component FROM clustered",
        "dbscan_noise": f"{DENSITY} SELECT id FROM p WHERE id NOT IN (SELECT id FROM clustered)",
    }


def model_sql() -> dict[str, str]:
    number = "CAST(regexp_extract(product_cat_lv2, '([0-9]+)$', 1) AS DOUBLE)"
    weekday = "DayOfWeek * {}"
    planted = "CAST(CASE WHEN list_contains(string_split(types, '|'), 'RF_A') THEN 40 ELSE 10 END AS DOUBLE)"
    weights = {"RF_A": (0.5, -1.25), "RF_R": (1.5, 0.25), "LS_F": (-0.75, 2.0)}
    flags = ", ".join(f"{flag_sql(c)} AS {c}" for c in weights)
    sums = ", ".join(
        "CAST(" + " + ".join(f"{c} * ({w[i]})" for c, w in weights.items()) + f" AS DOUBLE) AS promo_embed{i}"
        for i in range(2))
    return {
        "string_index": f"""WITH {FULL}, ranked AS (
            SELECT product_cat_lv2, row_number() OVER (ORDER BY count(*) DESC, product_cat_lv2) - 1 AS place
            FROM sales GROUP BY 1)
            SELECT {KEYS}, "Date", product_cat_lv2, CAST(place AS DOUBLE) AS product_cat_lv2_idx
            FROM sales JOIN ranked USING (product_cat_lv2)""",
        "category_index": f"""WITH {FULL}, ranked AS (
            SELECT MaterialCode, row_number() OVER (ORDER BY count(*) DESC, CAST(MaterialCode AS VARCHAR)) - 1 AS place
            FROM base WHERE "Date" < DATE '1995-07-01' GROUP BY 1)
            SELECT {KEYS}, "Date", CAST(coalesce(place, (SELECT count(*) FROM ranked)) AS DOUBLE) AS item_idx
            FROM base LEFT JOIN ranked USING (MaterialCode)""",
        "label_codes": f"""WITH {FULL}, labels AS (
            SELECT 'product_cat_lv2' AS "column", product_cat_lv2 AS code FROM sales
            UNION ALL SELECT 'DistrictEN', DistrictEN FROM sales
            UNION ALL SELECT 'DayOfWeek', CAST(DayOfWeek AS VARCHAR) FROM sales)
            SELECT "column", code, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, code) - 1 AS DOUBLE) AS place
            FROM labels WHERE code IS NOT NULL GROUP BY 1, 2""",
        "planted_forecast": f"""WITH {FULL} SELECT 'forecast' AS part, {KEYS}, "Date", {planted} AS prediction,
              NULL AS feature_name, NULL AS importance, NULL AS cumsum FROM base
            WHERE Date_EOM BETWEEN last_day(DATE '{START_OOT}') AND last_day(DATE '{END}')
            UNION ALL SELECT 'score', {KEYS}, DATE '2001-10-27', {planted}, NULL, NULL, NULL FROM base
            WHERE "Date" IN (DATE '2001-10-27', DATE '2001-10-20')
            UNION ALL SELECT 'importance', NULL, NULL, NULL, NULL, NULL, NULL, 'RF_A', CAST(1 AS DOUBLE), CAST(1 AS DOUBLE)""",
        "planted_boosted": f"""WITH {FULL},{SPLIT} SELECT OrderKey, LineNumber,
            CAST(MaterialCode AS VARCHAR) AS MaterialCode, CAST(BranchCode AS VARCHAR) AS BranchCode, "Date",
            {planted} AS prediction FROM test WHERE types IN (SELECT types FROM train)""",
        "saved_vectors": f"""WITH {FULL}, vectors AS (
            SELECT DISTINCT 'product_cat_lv2' AS "column", p_brand AS category,
              [CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS DOUBLE) / 2, -CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS DOUBLE) / 4, 1.0] AS v FROM part
            UNION ALL SELECT DISTINCT 'DayOfWeek', CAST(DayOfWeek AS VARCHAR), [DayOfWeek * 1.5, DayOfWeek * -0.5] FROM sales
            UNION ALL VALUES ('promo', 'RF_A', [0.5, -1.25]), ('promo', 'RF_R', [1.5, 0.25]), ('promo', 'LS_F', [-0.75, 2.0]))
            SELECT "column", category, place - 1 AS place, CAST(v[place] AS DOUBLE) AS value
            FROM (SELECT *, unnest(range(1, len(v) + 1)) AS place FROM vectors)""",
        "embedding_rows": f"""WITH {FULL} SELECT {KEYS}, "Date",
            CASE WHEN LineNumber % 2 <> 0 THEN CAST(DayOfWeek AS VARCHAR) ELSE 'others' END AS DayOfWeek,
            {rnd('CASE WHEN LineNumber % 3 = 1 THEN avgPrice ELSE 0 END')} AS avgPrice,
            {", ".join(f"{flag_sql(c)} AS {c}" for c in ("RF_A", "RF_R", "LS_F", "LS_O"))} FROM sales""",
        "rf_forecast": f"""WITH {FULL} SELECT {KEYS}, "Date", TotalQtySale, TRUE AS inside FROM base
            WHERE Date_EOM BETWEEN last_day(DATE '{START_OOT}') AND last_day(DATE '{END}')""",
        "feature_importance": """SELECT TRUE AS adds_up, TRUE AS positive, TRUE AS reaches_one,
            TRUE AS names_differ, TRUE AS falls""",
        "gbt_forecast": f"""WITH {FULL},{SPLIT} SELECT OrderKey, LineNumber,
            CAST(MaterialCode AS VARCHAR) AS MaterialCode, CAST(BranchCode AS VARCHAR) AS BranchCode, "Date",
            TotalQtySale, TRUE AS predicted FROM test WHERE types IN (SELECT types FROM train)""",
        "embedding_vectors": f"""WITH {FULL}, levels AS (
            SELECT DISTINCT 'product_cat_lv2' AS "column", product_cat_lv2 AS category FROM sales
            UNION ALL SELECT DISTINCT 'DistrictEN', DistrictEN FROM sales
            UNION ALL SELECT DISTINCT 'DayOfWeek', CAST(DayOfWeek AS VARCHAR) FROM sales)
            SELECT *, 4 AS size, TRUE AS finite FROM levels""",
        "embedding_lookup": f"""WITH {FULL} SELECT {KEYS}, "Date", product_cat_lv2, DayOfWeek,
            {number} / 2 AS product_cat_lv2_embed0, -{number} / 4 AS product_cat_lv2_embed1,
            CAST(1 AS DOUBLE) AS product_cat_lv2_embed2, CAST({weekday.format(1.5)} AS DOUBLE) AS DayOfWeek_embed0,
            CAST({weekday.format(-0.5)} AS DOUBLE) AS DayOfWeek_embed1 FROM sales""",
        "promo_embedding": f"""WITH {FULL}, flagged AS (SELECT {KEYS}, "Date", {flags} FROM base)
            SELECT *, {sums} FROM flagged""",
    }


def oracle_queries() -> dict[str, str]:
    return (feature_sql() | cleaning_sql() | dimension_sql() | average_sql() | store_sql()
            | density_sql() | model_sql())
