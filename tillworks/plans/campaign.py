"""Campaign analysis: a baseline window against an event day, a campaign window and an open window."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.functions import labels, money
from tillworks.plans import models
from tillworks.sources.tables import SalesTables


@dataclass(frozen=True)
class CampaignWindows:
    baseline_start: date
    baseline_end: date
    event_day: date
    campaign_start: date
    campaign_end: date
    open_start: date
    mobile_method: str
    promoted: tuple[str, ...]
    baseline_days: int = 20

    @property
    def baseline(self) -> tuple[date, date]:
        return self.baseline_start, self.baseline_end

    @property
    def campaign(self) -> tuple[date, date]:
        return self.campaign_start, self.campaign_end


CASE_2025 = CampaignWindows(
    baseline_start=date(2025, 11, 1),
    baseline_end=date(2025, 11, 20),
    event_day=date(2025, 11, 28),
    campaign_start=date(2025, 11, 28),
    campaign_end=date(2025, 12, 1),
    open_start=date(2025, 11, 27),
    mobile_method="mbway",
    promoted=("snacks", "cleaning"),
)
TABLES_1997 = CampaignWindows(
    baseline_start=date(1997, 11, 1),
    baseline_end=date(1997, 11, 20),
    event_day=date(1997, 11, 28),
    campaign_start=date(1997, 11, 28),
    campaign_end=date(1997, 12, 1),
    open_start=date(1997, 11, 27),
    mobile_method="1-urgent",
    promoted=("promo", "economy"),
)


def _within(window: tuple[date, date | None]) -> Column:
    """Days of a window; an open one has no end."""
    start, end = window
    day = F.col("transaction_date")
    return day >= F.lit(start) if end is None else day.between(F.lit(start), F.lit(end))


def _lines_where(t: SalesTables, days: Column) -> DataFrame:
    """Fact lines of the given days: the headers are cut down first, the lines meet what is left."""
    return t.lines.join(t.headers.where(days), "transaction_id")


def _daily(t: SalesTables, days: Column) -> DataFrame:
    return (
        _lines_where(t, days)
        .groupBy("transaction_date")
        .agg(
            F.sum("net_cents").alias("net_cents"),
            F.sum("discount_cents").alias("discount_cents"),
            F.sum("gross_cents").alias("gross_cents"),
        )
    )


def campaign_uplift(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """Event day against the baseline total divided by a fixed number of days; one scan for both."""
    in_base, on_event = _within(w.baseline), F.col("transaction_date") == F.lit(w.event_day)
    sums = _daily(t, in_base | on_event).agg(
        F.sum(F.when(in_base, F.col("net_cents"))).alias("base"),
        F.sum(F.when(on_event, F.col("net_cents"))).alias("event"),
    )
    per_day = F.round(money.divided(F.col("base"), F.lit(w.baseline_days)), 0)
    return sums.withColumn("daily", per_day).select(
        money.amount(F.col("base")).alias("baseline_revenue"),
        money.amount(F.col("daily")).alias("baseline_daily"),
        money.amount(F.col("event")).alias("bf_revenue"),
        money.percent_change(F.col("event"), F.col("daily")).alias("uplift_pct"),
    )


def _ratio_mean(window: Column) -> Column:
    ratio = F.try_divide(F.col("discount_cents").cast("double"), F.col("gross_cents").cast("double"))
    return F.avg(F.when(window, ratio))


def discount_ratio_by_period(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """Mean of the daily discount ratios, not the ratio of the sums."""
    base, campaign = _within(w.baseline), _within(w.campaign)
    return _daily(t, base | campaign).agg(
        F.round(100 * _ratio_mean(base), 2).alias("baseline_discount_pct"),
        F.round(100 * _ratio_mean(campaign), 2).alias("campaign_discount_pct"),
    )


def _headers_in(t: SalesTables, windows: dict[str, tuple[date, date | None]]) -> DataFrame:
    """Headers of the windows with the window's name. The days are compared first, so that they reach the scan."""
    days = reduce(Column.__or__, [_within(window) for window in windows.values()])
    return t.headers.where(days).withColumn("period", labels.period(F.col("transaction_date"), windows))


def _payment_mix(t: SalesTables, windows: dict[str, tuple[date, date | None]]) -> DataFrame:
    """Transactions with at least one line, by window and payment method, and their share of the window."""
    headers = _headers_in(t, windows).select(
        "transaction_id", "period", F.lower("payment_method").alias("payment_method")
    )
    sold = t.lines.select("transaction_id").join(headers, "transaction_id").distinct()
    mix = sold.groupBy("period", "payment_method").agg(F.count("*").alias("tx_count"))
    total = F.sum("tx_count").over(Window.partitionBy("period"))
    share = money.percent(F.col("tx_count"), total)
    return mix.select("period", "payment_method", "tx_count", share.alias("share_pct")).orderBy(
        "period", F.desc("share_pct"), "payment_method"
    )


def payment_mix_open(t: SalesTables, w: CampaignWindows) -> DataFrame:
    return _payment_mix(t, {"baseline": w.baseline, "campaign_plus": (w.open_start, None)})


def payment_mix_closed(t: SalesTables, w: CampaignWindows) -> DataFrame:
    return _payment_mix(t, {"baseline": w.baseline, "campaign": w.campaign})


def category_mix_wide(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """Every category that was ever sold, with its event-day and baseline revenue side by side.

    The sums read the days of the two windows only. Which products were ever sold is a question about
    products: it needs no header.
    """
    on_event = F.when(F.col("transaction_date") == F.lit(w.event_day), F.col("net_cents")).otherwise(0)
    in_base = F.when(_within(w.baseline), F.col("net_cents")).otherwise(0)
    days = _within(w.baseline) | (F.col("transaction_date") == F.lit(w.event_day))
    sums = (
        _lines_where(t, days)
        .groupBy("product_id")
        .agg(F.sum(on_event).alias("bf"), F.sum(in_base).alias("base"))
    )
    sold = t.lines.select("product_id").distinct()
    by_product = sold.join(sums, "product_id", "left").join(t.products.select("product_id", "category"), "product_id")
    zero = F.lit(0).cast("long")
    return (
        by_product.groupBy("category")
        .agg(
            money.amount(F.coalesce(F.sum("bf"), zero)).alias("bf_revenue"),
            money.amount(F.coalesce(F.sum("base"), zero)).alias("baseline_revenue"),
        )
        .orderBy(F.desc("bf_revenue"), "category")
    )


def category_mix_long(t: SalesTables, w: CampaignWindows) -> DataFrame:
    headers = _headers_in(t, {"baseline": w.baseline, "campaign": w.campaign}).select("transaction_id", "period")
    by_product = (
        t.lines.join(headers, "transaction_id").groupBy("product_id", "period").agg(F.sum("net_cents").alias("net_cents"))
    )
    return (
        by_product.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category", "period")
        .agg(money.amount(F.sum("net_cents")).alias("revenue"))
        .orderBy("category", "period")
    )


def _mobile_counts(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """Counts over all transactions of both windows, also those without a line."""
    base, campaign = _within(w.baseline), _within(w.campaign)
    mobile = F.lower("payment_method") == w.mobile_method

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return t.headers.where(base | campaign).agg(
        count(base & mobile).alias("base_mobile"),
        count(base).alias("base_all"),
        count(campaign & mobile).alias("campaign_mobile"),
        count(campaign).alias("campaign_all"),
    )


def campaign_kpis(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """All figures of the campaign page in one row; daily means run over the days that have sales."""
    base, campaign = _within(w.baseline), _within(w.campaign)

    def daily_mean(window: Column) -> Column:
        return money.divided(F.sum(F.when(window, F.col("net_cents"))), F.count(F.when(window, F.lit(1))))

    stats = _daily(t, base | campaign).agg(
        daily_mean(base).alias("base_mean"),
        daily_mean(campaign).alias("campaign_mean"),
        _ratio_mean(base).alias("base_ratio"),
        _ratio_mean(campaign).alias("campaign_ratio"),
    )
    counts = _mobile_counts(t, w).select(
        F.struct("base_mobile", "base_all", "campaign_mobile", "campaign_all").alias("counts")
    )
    both = stats.withColumn("counts", counts.scalar())
    uplift = F.try_divide(F.col("campaign_mean").cast("double"), F.col("base_mean").cast("double"))
    return both.select(
        money.amount(F.round("base_mean", 0)).alias("baseline_daily_avg"),
        money.amount(F.round("campaign_mean", 0)).alias("campaign_daily_avg"),
        F.round((uplift - 1) * 100, 2).alias("campaign_uplift_pct"),
        F.round(F.col("base_ratio") * 100, 2).alias("baseline_discount_ratio_pct"),
        F.round(F.col("campaign_ratio") * 100, 2).alias("campaign_discount_ratio_pct"),
        money.percent(F.col("counts.base_mobile"), F.col("counts.base_all")).alias("baseline_mobile_share_pct"),
        money.percent(F.col("counts.campaign_mobile"), F.col("counts.campaign_all")).alias("campaign_mobile_share_pct"),
    )


def _days_of_windows(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """One row per day of any window: amounts, those of the promoted categories, transactions and mobile ones.

    Lines are read once. They meet the headers of the windows, then the promoted products, and are added up per
    transaction before they are counted per day.
    """
    open_window = (w.open_start, None)
    days = _within(w.baseline) | _within(w.campaign) | _within(open_window) | (F.col("transaction_date") == F.lit(w.event_day))
    promoted = t.products.where(F.col("category").isin(*w.promoted)).select("product_id", F.lit(True).alias("promoted"))
    lines = _lines_where(t, days).join(promoted, "product_id", "left")
    mobile = (F.lower("payment_method") == w.mobile_method).cast("int")
    per_transaction = lines.groupBy("transaction_id", "transaction_date", mobile.alias("mobile")).agg(
        F.sum("net_cents").alias("net_cents"),
        F.sum("discount_cents").alias("discount_cents"),
        F.sum("gross_cents").alias("gross_cents"),
        F.sum(F.when(F.col("promoted"), F.col("net_cents"))).alias("promoted_cents"),
    )
    return per_transaction.groupBy("transaction_date").agg(
        *[F.sum(c).alias(c) for c in ("net_cents", "discount_cents", "gross_cents", "promoted_cents", "mobile")],
        F.count("*").alias("tickets"),
    )


def campaign_signals(t: SalesTables, w: CampaignWindows) -> DataFrame:
    """The four expected signals with the figures that confirm or refute them, all from one row per day.

    The mix report compares absolute revenue, and promotion lowers prices, so the promoted categories are
    held against their own daily baseline and not against the other categories.
    """
    base, campaign, opened = _within(w.baseline), _within(w.campaign), _within((w.open_start, None))
    on_event = F.col("transaction_date") == F.lit(w.event_day)

    def total(days: Column, column: str) -> Column:
        return F.sum(F.when(days, F.col(column)))

    def per_day(days: Column, column: str) -> Column:
        return F.round(money.divided(total(days, column), F.lit(w.baseline_days)), 0)

    def share(days: Column) -> Column:
        mobile = total(days, "mobile")
        return F.when(mobile > 0, money.percent(mobile, total(days, "tickets")))

    figures = {
        ("bf_revenue_spike", "up"): (money.amount(per_day(base, "net_cents")), money.amount(total(on_event, "net_cents"))),
        ("discount_ratio_up", "up"): (F.round(100 * _ratio_mean(base), 2), F.round(100 * _ratio_mean(campaign), 2)),
        ("mobile_payment_share_up", "up"): (share(base), share(opened)),
        ("category_mix_shift", "_and_".join(w.promoted) + "_up"): (
            money.amount(per_day(base, "promoted_cents")),
            money.amount(total(on_event, "promoted_cents")),
        ),
    }
    names = [(f"before{i}", f"after{i}") for i in range(len(figures))]
    one_row = _days_of_windows(t, w).agg(
        *[value.cast("double").alias(name) for pair, both in zip(names, figures.values()) for name, value in zip(pair, both)]
    )
    signals = [
        F.struct(
            F.lit(signal).alias("signal"),
            F.lit(direction).alias("direction"),
            F.col(before).alias("baseline_value"),
            F.col(after).alias("campaign_value"),
        )
        for (signal, direction), (before, after) in zip(figures, names)
    ]
    risen = F.coalesce(F.col("campaign_value") > F.col("baseline_value"), F.lit(False))
    return one_row.select(F.inline(F.array(*signals))).withColumn("ok", risen)
