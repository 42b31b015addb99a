"""The six report views. Column names are the public, partly Turkish ones.

Each function takes the tables it reads and returns a lazy frame. The views
on facts show current store and product versions only, so facts bound to an
expired version drop out; ``history='as_was'`` keeps them, with the
attributes of the version they were sold under.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.dictionaries import SALE, dictionary, type_ids
from tezgah.functions.expressions import UNKNOWN, exact_sum, guarded_ratio, half_up_int, major_units, minor_units, ntz
from tezgah.operators.lookups import with_member
from tezgah.operators.ranking import Score, ntiles
from tezgah.sources.shared import cut

# Labels as the reports print them.
STOCK_OUT, CRITICAL, LOW = "🔴 Stok Tükendi", "🟠 Kritik Stok", "🟡 Düşük Stok"
OVERSTOCK, SLOW, NORMAL = "🔵 Fazla Stok", "⚫ Yavaş Hareket", "🟢 Normal"
STATUS_ICONS = {"SUCCESS": "✅", "RUNNING": "⏳", "FAILED": "❌"}
OTHER_STATUS_ICON = "⚠️"


def _current(dimension: DataFrame, history: str) -> DataFrame:
    if history not in ("current", "as_was"):
        raise ValueError(f"history must be 'current' or 'as_was', not {history!r}")
    return dimension if history == "as_was" else dimension.filter("is_current")


def _small(df: DataFrame, name: str) -> DataFrame:
    """A dictionary table for a join; a dozen rows, hence broadcast."""
    return F.broadcast(dictionary(df.sparkSession, name))


def _sites(stores: DataFrame, regions: DataFrame, history: str) -> DataFrame:
    """Stores with format name and region attributes, joined on the dimension side."""
    formats = _small(stores, "d_store_format").select("format_code", "format_name")
    places = regions.select("region_sk", "city", "district", "nuts2_name", "population_segment")
    return (
        _current(stores, history).join(formats, "format_code").join(places, "region_sk", "left")
    )


def _goods(products: DataFrame, categories: DataFrame, history: str) -> DataFrame:
    """Products with their category attributes, joined on the dimension side."""
    kinds = categories.select(
        "category_sk", "department_code", "department_name", "category_code", "category_name",
        "subcategory_name", "is_food", F.col("is_private_label").alias("category_private_label"),
    )
    return _current(products, history).join(kinds, "category_sk")


def _dated(facts: DataFrame, days: DataFrame) -> DataFrame:
    """Facts with attributes of their day. Over a table partitioned by month the month is a key too, so that a filter on the calendar prunes months."""
    if "year_month" not in facts.columns:
        return facts.join(F.broadcast(days), "date_id")
    keyed = days.withColumn("year_month", F.expr("date_id div 100").cast("int"))
    return facts.join(F.broadcast(keyed), ["date_id", "year_month"]).drop("year_month")


def sales_daily(
    sales: DataFrame, calendar: DataFrame, stores: DataFrame, products: DataFrame,
    categories: DataFrame, customers: DataFrame, campaigns: DataFrame, regions: DataFrame,
    history: str = "current", send_stores: bool = False,
) -> DataFrame:
    """Receipt lines with their full context: 52 columns. ``send_stores`` broadcasts the stores, for callers that know they are few."""
    days = {
        "full_date": "full_date", "day_name_tr": "gun", "week_of_year": "hafta",
        "month_name_tr": "ay", "month_number": "month_number", "quarter_name": "ceyrek",
        "year_number": "yil", "fiscal_year": "mali_yil", "fiscal_month": "mali_ay",
        "is_weekend": "hafta_sonu_mu", "is_public_holiday": "tatil_mi", "season": "mevsim",
    }
    site = {
        "store_id": "store_id", "store_code": "store_code", "store_name": "magaza_adi",
        "format_name": "magaza_formati", "cluster": "magaza_segmenti", "store_sqm": "magaza_m2",
        "is_mall_store": "avm_magaza_mi", "city": "sehir", "district": "ilce",
        "nuts2_name": "bolge", "population_segment": "sehir_turu",
    }
    good = {
        "sku_code": "sku_code", "product_name": "urun_adi", "brand": "marka",
        "department_name": "departman", "category_name": "kategori",
        "subcategory_name": "alt_kategori", "is_private_label": "ozel_marka_mi",
        "is_perishable": "bozulabilir_mi",
    }
    buyer = {
        "customer_segment": "musteri_segmenti", "loyalty_tier": "sadakat_turu",
        "age_band": "yas_grubu", "gender": "cinsiyet",
    }
    offer = {"campaign_name": "kampanya_adi", "campaign_type": "kampanya_turu"}
    measures = {
        "quantity": "adet", "unit_list_price": "liste_fiyati", "unit_selling_price": "satis_fiyati",
        "unit_cost": "maliyet", "gross_sales_amount": "brut_satis",
        "discount_amount": "indirim_tutari", "net_sales_amount": "net_satis",
        "cogs_amount": "satis_maliyeti", "gross_margin_amount": "brut_kar",
    }

    def named(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
        return df.select(key, *[F.col(c).alias(n) for c, n in columns.items()])

    lines = sales.select(
        "transaction_id", "transaction_type_id", "payment_method_id", "line_number",
        "date_id", "store_sk", "product_sk", "customer_sk", "campaign_sk",
        *[c for c in sales.columns if c == "year_month"],
        *[F.col(c).alias(n) for c, n in measures.items()],
    )
    types = _small(sales, "d_transaction_type").select(
        "transaction_type_id", F.col("type_name").alias("islem_turu")
    )
    methods = _small(sales, "d_payment_method").select(
        "payment_method_id", F.col("method_name").alias("odeme_yontemi")
    )
    spread = ("transaction_id", "line_number")
    sites = named(_sites(stores, regions, history), "store_sk", site)
    # Joins that may shuffle come first, while lines are narrow; those with texts of a broadcast side last.
    if send_stores:
        lines = lines.join(F.broadcast(sites.select("store_sk")), "store_sk", "left_semi")
    wide = with_member(lines, customers, "customer_sk", buyer, spread)
    wide = wide.join(named(_goods(products, categories, history), "product_sk", good), "product_sk")
    wide = wide.join(F.broadcast(sites) if send_stores else sites, "store_sk")
    wide = (
        _dated(wide, named(calendar, "date_id", days))
        .join(types, "transaction_type_id")
        .join(methods, "payment_method_id", "left")
    )
    wide = with_member(wide, campaigns, "campaign_sk", offer, spread)
    return wide.select(
        *days.values(), *site.values(), *good.values(), *buyer.values(), *offer.values(),
        "transaction_id", "transaction_type_id", "islem_turu", "odeme_yontemi",
        *measures.values(),
        guarded_ratio("brut_kar", "net_satis", per=100, otherwise=0).alias("brut_kar_marji_pct"),
        guarded_ratio("net_satis", "magaza_m2").alias("m2_basi_satis"),
    )


def store_kpi_monthly(
    kpi: DataFrame, calendar: DataFrame, stores: DataFrame, regions: DataFrame,
    history: str = "current",
) -> DataFrame:
    """Daily KPIs rolled up to store and month: 30 columns.

    Daily ratios are averaged over the days (they do not add up); ratios of
    the month are ratios of sums. Days fold per store version before the
    store attributes join.
    """
    days = calendar.select(
        "date_id", F.col("year_number").alias("yil"), F.col("fiscal_year").alias("mali_yil"),
        "month_number", F.col("month_name_tr").alias("ay"), F.col("fiscal_month").alias("mali_ay"),
    )
    month = ["yil", "mali_yil", "month_number", "ay", "mali_ay"]
    sums = {
        "gross_sales": "brut_satis", "discount_amount": "toplam_indirim", "net_sales": "net_satis",
        "cogs": "satis_maliyeti", "gross_margin": "brut_kar", "return_amount": "iade_tutari",
        "units_sold": "satilan_adet", "transaction_count": "islem_sayisi",
        "unique_customers": "tekil_musteri", "sales_target": "satis_hedefi",
    }
    means = {
        "avg_basket_size": "ort_sepet_buyuklugu", "avg_basket_items": "ort_sepet_urun",
        "gross_margin_pct": "ort_kar_marji", "return_rate_pct": "ort_iade_orani",
    }
    site = ["store_id", "store_code", "store_name", "format", "sehir", "bolge", "cluster"]
    sites = _sites(stores, regions, history).select(
        "store_sk", "store_id", "store_code", "store_name", F.col("format_name").alias("format"),
        F.col("city").alias("sehir"), F.col("nuts2_name").alias("bolge"), "cluster", "store_sqm",
    )
    added = [*sums, *means]
    per_version = _dated(kpi, days).groupBy(*month, "store_sk").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in added],
        # sum and count of the exact decimals; the mean itself is taken in DOUBLE
        *[F.count(c).alias(f"_n_{c}") for c in means],
        F.collect_set("date_id").alias("_days"),  # 31 at most
    )
    rolled = per_version.join(sites, "store_sk").groupBy(*month, *site).agg(
        *[F.sum(f"_sum_{c}").alias(n) for c, n in sums.items()],
        *[F.sum(f"_sum_{c}").alias(f"_sum_{n}") for c, n in means.items()],
        *[F.sum(f"_n_{c}").alias(f"_n_{n}") for c, n in means.items()],
        F.max("store_sqm").alias("_sqm"),
        F.size(F.array_distinct(F.flatten(F.collect_list("_days")))).cast("bigint").alias("calisilan_gun_sayisi"),
    )
    return rolled.select(
        *month, *site,
        "brut_satis", "toplam_indirim", "net_satis", "satis_maliyeti", "brut_kar",
        guarded_ratio("brut_kar", "net_satis", per=100, otherwise=0).alias("brut_kar_marji_pct"),
        "iade_tutari", "satilan_adet", "islem_sayisi", "tekil_musteri",
        *[guarded_ratio(f"_sum_{n}", f"_n_{n}").alias(n) for n in means.values()],
        "satis_hedefi",
        guarded_ratio("net_satis", "satis_hedefi", per=100).alias("hedefe_ulasma_pct"),
        guarded_ratio("net_satis", "_sqm").alias("m2_basi_satis"),
        "calisilan_gun_sayisi",
    )


def inventory_alert(
    inventory: DataFrame, calendar: DataFrame, stores: DataFrame, products: DataFrame,
    categories: DataFrame, regions: DataFrame, history: str = "current",
) -> DataFrame:
    """Stock rows that need attention, with the class of alert: 20 columns."""
    alarming = (
        F.col("is_stockout") | F.col("is_overstock") | F.col("is_slow_mover")
        | (F.col("days_of_stock") < 7)
    )
    left = F.col("days_of_stock")
    label = (
        F.when(F.col("is_stockout"), STOCK_OUT)
        .when(left < 3, CRITICAL)
        .when(left < 7, LOW)
        .when(F.col("is_overstock"), OVERSTOCK)
        .when(F.col("is_slow_mover"), SLOW)
        .otherwise(NORMAL)
    )
    sites = _current(stores, history).join(
        regions.select("region_sk", "city"), "region_sk", "left"
    ).select("store_sk", "store_id", "store_code", "store_name", "city")
    goods = _goods(products, categories, history).select(
        "product_sk", "sku_code", "product_name", "brand", "department_name", "category_name"
    )
    rows = (
        inventory.filter(alarming)
        .join(F.broadcast(calendar.select("date_id", "full_date")), "date_id")
        .join(sites, "store_sk")
        .join(goods, "product_sk")
    )
    return rows.select(
        "full_date", "store_id", "store_code", "store_name", "city", "sku_code", "product_name",
        "brand", "department_name", "category_name",
        F.col("stock_qty").alias("mevcut_stok"),
        F.col("min_stock_level").alias("min_stok"),
        F.col("max_stock_level").alias("max_stok"),
        left.alias("stok_gunu"),
        F.col("stock_value_cost").alias("stok_degeri_maliyet"),
        F.col("stock_value_retail").alias("stok_degeri_satis"),
        F.col("is_stockout").alias("stok_bitti_mi"),
        F.col("is_overstock").alias("fazla_stok_mu"),
        F.col("is_slow_mover").alias("yavash_satici_mi"),
        label.alias("stok_durumu"),
    )


def category_performance(
    sales: DataFrame, calendar: DataFrame, stores: DataFrame, products: DataFrame,
    categories: DataFrame, regions: DataFrame, history: str = "current",
) -> DataFrame:
    """Profit and loss by month, category, store format and region: 23 columns.

    Grouping by fourteen attributes would carry all their text through the
    shuffle of two distinct counts. Month and category travel as integer
    keys instead and get their attributes back on the result rows.
    """
    attributes = [
        "department_code", "department_name", "category_code", "category_name",
        "subcategory_name", "is_food", "category_private_label",
    ]
    kinds = categories.select(
        "category_sk", "department_code", "department_name", "category_code", "category_name",
        "subcategory_name", "is_food", F.col("is_private_label").alias("category_private_label"),
    )
    # Categories with equal attributes form one group, under the smallest of their keys.
    shared = kinds.groupBy(*attributes).agg(F.min("category_sk").alias("_kind"))
    equal = [F.col(f"k.{a}").eqNullSafe(F.col(f"s.{a}")) for a in attributes]
    members = (
        kinds.alias("k").join(shared.alias("s"), reduce(and_, equal)).select("category_sk", "_kind")
    )
    items = _current(products, history).select("product_sk", "category_sk").join(members, "category_sk")

    sites = _sites(stores, regions, history).select(
        "store_sk", F.col("format_name").alias("magaza_formati"), F.col("nuts2_name").alias("bolge")
    )
    month = ["year_number", "fiscal_year", "month_number", "month_name_tr", "quarter_name"]
    days = calendar.select("date_id", "year_number", "month_number")
    lines = (
        _dated(sales.filter(F.col("transaction_type_id").isin(type_ids("affects_revenue"))), days)
        .join(items.select("product_sk", "_kind"), "product_sk")
        .join(sites, "store_sk")
    )
    group = ["year_number", "month_number", "_kind", "magaza_formati", "bolge"]
    measures = {
        "quantity": "satilan_adet", "net_sales_amount": "net_satis", "cogs_amount": "maliyet",
        "gross_margin_amount": "brut_kar", "discount_amount": "indirim",
    }
    # Lines fold once into two kinds of rows, per receipt (with the sums) and per product; their counts are the distinct counts.
    digits = {n: 3 if c == "quantity" else 2 for c, n in measures.items()}
    amounts = [minor_units(c, digits[n]).alias(n) for c, n in measures.items()]
    receipt = F.struct(F.lit(True).alias("_receipt"), F.col("transaction_id").alias("_id"), *amounts)
    product = F.struct(F.lit(False).alias("_receipt"), F.col("product_sk").cast("bigint").alias("_id"), *[F.lit(None).cast("bigint").alias(n) for n in measures.values()])
    folded = lines.select(*group, F.inline(F.array(receipt, product))).groupBy(*group, "_receipt", "_id").agg(*[F.sum(n).alias(n) for n in measures.values()])
    totals = folded.groupBy(*group).agg(
        F.count_if("_receipt").alias("islem_sayisi"),
        F.count_if(~F.col("_receipt")).alias("urun_cesidi"),
        *[major_units(F.sum(n), digits[n]).alias(n) for n in measures.values()],
    )
    months = calendar.select(*month).distinct()
    named = totals.join(F.broadcast(months), ["year_number", "month_number"]).join(shared, "_kind")
    return named.select(
        "year_number", "fiscal_year", "month_number", F.col("month_name_tr").alias("ay"),
        F.col("quarter_name").alias("ceyrek"), "department_code",
        F.col("department_name").alias("departman"), "category_code",
        F.col("category_name").alias("kategori"), F.col("subcategory_name").alias("alt_kategori"),
        "is_food", F.col("category_private_label").alias("is_private_label"),
        "magaza_formati", "bolge", "islem_sayisi", "urun_cesidi", *measures.values(),
        guarded_ratio("brut_kar", "net_satis", per=100, otherwise=0).alias("kar_marji_pct"),
        guarded_ratio("indirim", "net_satis", per=100, otherwise=0).alias("indirim_orani_pct"),
    )


def rfm_base(sales: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Recency, frequency and spend per customer version.

    Lines fold per customer first; the attributes depend on the customer key,
    so they join the result instead of widening the shuffle.
    """
    bought = sales.filter(
        (F.col("customer_sk") != UNKNOWN) & (F.col("transaction_type_id") == SALE)
    )
    per_customer = bought.groupBy("customer_sk").agg(
        F.max("date_id").alias("_last"),
        F.count_distinct("transaction_id").alias("alisveris_sayisi"),
        exact_sum("net_sales_amount").alias("toplam_harcama"),
    )
    last = F.to_date(F.col("_last").cast("string"), "yyyyMMdd")
    attributes = customers.select(
        "customer_sk", "customer_segment", "loyalty_tier", "age_band", "gender", "city"
    )
    return (
        per_customer.withColumn("son_alisveris_tarihi", last)
        .withColumn("recency_gun", F.datediff(F.lit(as_of), "son_alisveris_tarihi"))
        .drop("_last")
        .join(attributes, "customer_sk")
    )


RFM_SCORES = {
    "r_score": Score("recency_gun", descending=True),
    "f_score": Score("alisveris_sayisi"),
    "m_score": Score("toplam_harcama"),
}


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """The segment label; the first rule that holds wins.

    The sixth rule can never win, as the fifth covers it; it stays for
    whoever reads the rules.
    """
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Şampiyon")
        .when((r >= 3) & (f >= 3), "Sadık Müşteri")
        .when((r >= 4) & (f <= 2), "Yeni Müşteri")
        .when((r >= 3) & (f <= 2) & (m >= 3), "Potansiyel Sadık")
        .when((r <= 2) & (f >= 3), "Risk Altında")
        .when((r <= 2) & (f >= 4), "Kaybedilecek")
        .when((r == 1) & (f == 1), "Kayıp Müşteri")
        .otherwise("İzlemede")
    )


def customer_rfm(sales: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Customers scored 1-5 on recency, frequency and spend: 15 columns."""
    base = cut(rfm_base(sales, customers, as_of))
    scored = base.join(ntiles(base, "customer_sk", RFM_SCORES, 5), "customer_sk")
    r, f, m = (F.col(c) for c in RFM_SCORES)
    return scored.select(
        "customer_sk", "son_alisveris_tarihi", "alisveris_sayisi",
        F.round("toplam_harcama", 2).alias("toplam_harcama"), "recency_gun",
        "r_score", "f_score", "m_score", (r + f + m).alias("rfm_toplam"),
        rfm_segment(r, f, m).alias("rfm_segmenti"),
        "customer_segment", "loyalty_tier", "age_band", "gender", "city",
    )


def etl_monitor(batches: DataFrame, now: str) -> DataFrame:
    """Batches, newest first, with their duration and a status icon: 17 columns.

    ``now`` stands for the end of batches still running.
    """
    end = F.coalesce("end_time", ntz(now))
    seconds = F.timestamp_diff("MICROSECOND", F.col("start_time"), end) / F.lit(1000000)
    icon = F.lit(OTHER_STATUS_ICON)
    for status, sign in STATUS_ICONS.items():
        icon = F.when(F.col("status") == status, sign).otherwise(icon)
    return batches.select(
        "batch_id", "batch_name", "target_table", "load_strategy", "source_system", "status",
        "start_time", "end_time", half_up_int(seconds).alias("sure_saniye"),
        "rows_extracted", "rows_inserted", "rows_updated", "rows_rejected",
        "watermark_from", "watermark_to", "error_message", icon.alias("durum_icon"),
    ).orderBy(F.col("batch_id").desc())
