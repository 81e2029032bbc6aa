"""Column names, periods and groupings shared by training and scoring.

One set of group specifications serves both jobs, so a model never meets a
feature at scoring time that it was not trained on.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values: column names of the sales model -------------------------
DATE = "Date"
MONTH = "Date_EOM"
QUANTITY = "TotalQtySale"
NET_SALE = "TotalNetSale"
SOLD = "label"
ITEM = "MaterialCode"
STORE = "BranchCode"
PROMOTION = "types"
NO_PROMOTION = "NORMAL"
CATEGORY_1 = "product_cat_lv1"
CATEGORY_2 = "product_cat_lv2"
KEYS = ["idx"]

# --- Fixed values: periods -------------------------------------------------
START = "2020-01-01"
START_DEV = "2020-06-01"
START_OOT = "2020-12-01"
END = "2020-12-31"
HORIZONS = (60, 90, 180)
RATIOS = ((90, 180),)
TRAINING_LAG = 5
SCORING_LAG = 7
LONGEST_GAP = 90
PROMO_CUTOFF = 0.99

# --- Fixed values: grouping sets of the trailing and recency features ------
TRAILING_GROUPS = {
    "mc": ("MaterialCode",),
    "br": ("BranchCode",),
    "mc_dow": ("MaterialCode", "DayOfWeek"),
    "mc_pv": ("MaterialCode", "ProvinceEN"),
    "mc_ds": ("MaterialCode", "DistrictEN"),
    "cat_lv2": (CATEGORY_2,),
    "cat_lv2_pv": (CATEGORY_2, "ProvinceEN"),
    "cat_lv2_ds": (CATEGORY_2, "DistrictEN"),
    "cat_lv2_dow": (CATEGORY_2, "DayOfWeek"),
    "cat_lv2_br": (CATEGORY_2, "BranchCode"),
}
RECENCY_GROUPS = {
    "mc_br": ("MaterialCode", "BranchCode"),
    "mc_ds": ("MaterialCode", "DistrictEN"),
    "cat_lv2_ds": (CATEGORY_2, "DistrictEN"),
    "cat_lv2_br": (CATEGORY_2, "BranchCode"),
}

# --- Fixed values: columns that follow from the date ------------------------
CALENDAR = ("Yearday", "Month", "DayOfWeek", "DayOfMonth", "Year", "Quarter", "WeekOfYear", "MonthQuarter")

# Roll-ups per day that the grouping sets are derived from: each is read many
# times in place of the fact.
ROLLUPS = {
    "daily_item_ft": (ITEM, "ProvinceEN", "DistrictEN", "DayOfWeek"),
    "daily_category_ft": (CATEGORY_2, STORE, "ProvinceEN", "DistrictEN", "DayOfWeek"),
}

# --- Fixed values: model inputs --------------------------------------------
BASIC_NUMBERS = [
    "avgPriceDis", "avgPrice", "supPrice", "DayOfMonth", "DayOfWeek", "Quarter",
    "MonthQuarter", "Month", "WeekOfYear", "latitude", "longitude", "revenue",
    "discount", "percentage_discount", "YearOpened", "MonthOpened",
]
PROMO_NUMBERS = [
    "BG003", "DS001", "DS002", "DS005", "DS004", "DS003", "FR001", "GS002",
    "DG001", "FR002", "GS003",
]
CATEGORIES = [
    "LocationCluster", "StoreType", "ProvinceEN", "DistrictEN", CATEGORY_1, CATEGORY_2,
]
EMBEDDED_CATEGORIES = [
    CATEGORY_1, CATEGORY_2, "DayOfWeek", "DistrictEN", "ProvinceEN",
    "Quarter", "MonthQuarter", "DayOfMonth",
]
EMBEDDING_NUMBERS = [
    "Month", "avgPriceDis", "avgPrice", "supPrice", "WeekOfYear",
    "TotalQtySale_avg_180d_mc", "TotalQtySale_avg_90d_mc", "TotalQtySale_sum_180d_mc",
    "TotalQtySale_avg_60d_mc", "TotalQtySale_sum_90d_mc_dow", "TotalQtySale_sum_60d_mc_dow",
    "TotalNetSale_avg_180d_mc_inc0", "TotalQtySale_avg_180d_mc_dow",
    "TotalNetSale_avg_180d_mc_dow", "TotalQtySale_sum_180d_mc_dow",
]
PROMO_CODE_PATTERN = r"^[A-Z]{2}[0-9]{3}$"

# --- Fixed values: inputs of the historical-average baseline job -----------
BASELINE_NUMBERS = [
    "avgPriceDis", "avgPrice", "Yearday", "Month", "DayOfWeek", "Year",
    "Quarter", "WeekOfYear", "DayOfMonth",
]
BASELINE_STRINGS = ["BranchCode", "MaterialCode", "types"]


@dataclass(frozen=True)
class TrailingSpec:
    """Lagged trailing statistics of one grouping set."""

    name: str
    group_cols: tuple[str, ...]
    measures: tuple[str, ...] = (QUANTITY, NET_SALE)
    horizons: tuple[int, ...] = HORIZONS
    ratios: tuple[tuple[int, int], ...] = RATIOS
    lag: int = TRAINING_LAG
    sold: str = SOLD
    date: str = DATE

    def column(self, measure: str, stat: str, days: int, all_days: bool = False) -> str:
        suffix = "_inc0" if all_days else ""
        return f"{measure}_{stat}_{days}d_{self.name}{suffix}"

    def ratio_column(self, measure: str, short: int, long: int) -> str:
        return f"{measure}_sum_ratio_{short}d{long}d_{self.name}"

    def columns(self) -> list[str]:
        """Output columns, known before any data is read."""
        names = []
        for measure in self.measures:
            for days in self.horizons:
                names.append(self.column(measure, "sum", days))
                for stat in ("avg", "stddev", "cv"):
                    names.append(self.column(measure, stat, days))
                    names.append(self.column(measure, stat, days, all_days=True))
            names += [self.ratio_column(measure, a, b) for a, b in self.ratios]
        return names

    def history_days(self) -> int:
        """Days of input needed before the first output day.

        A deviation looks back one frame at days that each carry an average
        over a frame of their own, hence twice the frame.
        """
        return 2 * (max(self.horizons) + self.lag + 1)


@dataclass(frozen=True)
class RecencySpec:
    """Days without a sale, and the longest such run, of one grouping set."""

    name: str
    group_cols: tuple[str, ...]
    horizons: tuple[int, ...] = HORIZONS
    lag: int = TRAINING_LAG
    flag: str = SOLD
    date: str = DATE
    longest: int = LONGEST_GAP

    @property
    def run_column(self) -> str:
        return f"zero_consc_{self.name}"

    def max_column(self, days: int) -> str:
        return f"zero_consc_max_{days}d_{self.name}"

    def columns(self) -> list[str]:
        return [self.run_column] + [self.max_column(days) for days in self.horizons]

    def history_days(self) -> int:
        return (max(self.horizons) + self.lag + 1) + (self.longest + self.lag)


@dataclass(frozen=True)
class FeaturePlan:
    """Everything the training and scoring jobs must agree on."""

    keys: tuple[str, ...] = tuple(KEYS)
    trailing: tuple[TrailingSpec, ...] = field(
        default_factory=lambda: tuple(TrailingSpec(n, g) for n, g in TRAILING_GROUPS.items()))
    recency: tuple[RecencySpec, ...] = field(
        default_factory=lambda: tuple(RecencySpec(n, g) for n, g in RECENCY_GROUPS.items()))
    basic_numbers: tuple[str, ...] = tuple(BASIC_NUMBERS)
    promo_numbers: tuple[str, ...] = tuple(PROMO_NUMBERS)
    categories: tuple[str, ...] = tuple(CATEGORIES)

    def with_lag(self, lag: int) -> FeaturePlan:
        return replace(
            self,
            trailing=tuple(replace(s, lag=lag) for s in self.trailing),
            recency=tuple(replace(s, lag=lag) for s in self.recency),
        )

    def numbers(self) -> list[str]:
        names = list(self.basic_numbers) + list(self.promo_numbers)
        for spec in self.trailing + self.recency:
            names += spec.columns()
        return names

    def history_days(self) -> int:
        return max(s.history_days() for s in self.trailing + self.recency)

    def measures(self) -> list[str]:
        return list(dict.fromkeys(m for s in self.trailing for m in s.measures))
