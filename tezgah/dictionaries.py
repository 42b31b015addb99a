"""The seven dictionary tables of the warehouse.

Fixed values: codes, flags and Turkish labels are data that reports show
as they stand, so they are stated here row by row. Every table has at most
twelve rows, which is what makes ``broadcast`` safe for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tezgah.functions.literals import literal_rows

_DICTIONARIES: dict[str, tuple[str, list[tuple]]] = {
    "d_currency": (
        "currency_code string, currency_name string, currency_symbol string, is_active boolean",
        [
            ("TRY", "Türk Lirası", "₺", True),
            ("USD", "US Dollar", "$", True),
            ("EUR", "Euro", "€", True),
        ],
    ),
    "d_day_type": (
        "day_type_id int, day_type_name string, is_working_day boolean",
        [
            (1, "Hafta İçi", True),
            (2, "Cumartesi", True),
            (3, "Pazar", False),
            (4, "Resmi Tatil", False),
            (5, "Dini Bayram", False),
            (6, "Yarım Gün", True),
        ],
    ),
    "d_store_format": (
        "format_code string, format_name string, avg_sqm_min int, avg_sqm_max int, description string",
        [
            ("HYPER", "Hipermarket", 5000, 15000, "Büyük alışveriş merkezi mağazası"),
            ("SUPER", "Süpermarket", 1000, 4999, "Orta ölçekli market"),
            ("EXPRESS", "Express / Mahalle", 100, 999, "Küçük mahalle mağazası"),
            ("ONLINE", "Online Kanal", None, None, "E-ticaret kanalı"),
            ("OUTLET", "Outlet Mağaza", 500, 3000, "İndirimli outlet formatı"),
        ],
    ),
    "d_product_status": (
        "status_code string, status_name string, is_sellable boolean",
        [
            ("ACTIVE", "Aktif", True),
            ("PASSIVE", "Pasif", False),
            ("SEASONAL", "Sezonluk", True),
            ("CLEARANCE", "Tasfiye", True),
            ("DISCONTINUED", "Üretimi Durdu", False),
            ("NEW", "Yeni Ürün", True),
        ],
    ),
    "d_transaction_type": (
        "transaction_type_id int, type_name string, affects_inventory boolean, "
        "affects_revenue boolean, direction string",
        [
            (1, "Normal Satış", True, True, "-"),
            (2, "İade", True, True, "+"),
            (3, "İptal", False, True, "+"),
            (4, "Stok Girişi", True, False, "+"),
            (5, "Stok Çıkışı (Fire)", True, False, "-"),
            (6, "Transfer Çıkış", True, False, "-"),
            (7, "Transfer Giriş", True, False, "+"),
            (8, "Kampanya İndirimi", False, True, "-"),
            (9, "Sayım Düzeltme", True, False, "+"),
        ],
    ),
    "d_payment_method": (
        "payment_method_id int, method_name string, is_digital boolean",
        [
            (1, "Nakit", False),
            (2, "Kredi Kartı", False),
            (3, "Banka Kartı", False),
            (4, "Temassız", True),
            (5, "Mobil Ödeme", True),
            (6, "Hediye Çeki", False),
            (7, "Kurumsal Fatura", False),
            (8, "Online / Kapıda", True),
        ],
    ),
    "d_kpi_definition": (
        "kpi_code string, kpi_name string, kpi_category string, unit string, "
        "higher_is_better boolean, description string, formula string",
        [
            ("NET_SALES", "Net Satış Tutarı", "Finansal", "TRY", True,
             "İadeler düşülmüş net satış", "gross_sales - returns"),
            ("GROSS_MARGIN", "Brüt Kâr Marjı", "Finansal", "%", True,
             "(Satış - COGS) / Satış", "(net_sales - cogs) / net_sales * 100"),
            ("UNITS_SOLD", "Satılan Adet", "Satış", "Adet", True,
             "Toplam satılan ürün adedi", "SUM(quantity)"),
            ("BASKET_SIZE", "Sepet Büyüklüğü", "Müşteri", "TRY", True,
             "Ortalama işlem tutarı", "net_sales / transaction_count"),
            ("BASKET_ITEMS", "Sepetteki Ürün Adedi", "Müşteri", "Adet", True,
             "İşlem başına ortalama ürün", "units_sold / transaction_count"),
            ("CONVERSION_RATE", "Dönüşüm Oranı", "Müşteri", "%", True,
             "Alışveriş yapan / toplam giriş", "buyers / visitors * 100"),
            ("STOCKOUT_RATE", "Stok Tükenme Oranı", "Stok", "%", False,
             "Stokta olmayan SKU oranı", "stockout_sku / total_sku * 100"),
            ("INVENTORY_TURN", "Stok Devir Hızı", "Stok", "x/yıl", True,
             "COGS / Ortalama Stok Değeri", "cogs / avg_inventory_value"),
            ("SHRINKAGE_RATE", "Fire ve Kayıp Oranı", "Stok", "%", False,
             "Kayıp stok / toplam stok", "shrinkage / total_inventory * 100"),
            ("SALES_PER_SQM", "M² Başına Satış", "Verimlilik", "TRY/m²", True,
             "Net satış / mağaza m²", "net_sales / store_sqm"),
            ("STAFF_SALES", "Çalışan Başına Satış", "İK", "TRY", True,
             "Net satış / çalışan sayısı", "net_sales / headcount"),
            ("NPS", "Net Tavsiye Skoru", "Müşteri", "Puan", True,
             "Müşteri memnuniyeti endeksi", "promoters% - detractors%"),
        ],
    ),
}

# The transaction type ids the KPI formulas name.
SALE, RETURN, SHRINKAGE = 1, 2, 5

NAMES = tuple(_DICTIONARIES)


def dictionary(spark: SparkSession, name: str) -> DataFrame:
    """One dictionary table, by name (``d_transaction_type``, ...)."""
    schema, rows = _DICTIONARIES[name]
    return literal_rows(spark, rows, schema)


def type_ids(flag: str | None = None, direction: str | None = None) -> list[int]:
    """Ids of the transaction types with the given flag and direction.

    A filter on these ids reaches the Parquet scan; a join on the nine-row
    dictionary would not.
    """
    schema, rows = _DICTIONARIES["d_transaction_type"]
    names = [field.strip().split()[0] for field in schema.split(",")]
    picked = [dict(zip(names, row)) for row in rows]
    return [
        row["transaction_type_id"]
        for row in picked
        if (flag is None or row[flag]) and (direction is None or row["direction"] == direction)
    ]
