"""Store dimension from the ERP and POS store lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import camel_to_snake, rename_all
from ..functions.text import clean_address, delete, title_case
from ..functions.values import map_values, replace_values
from .joining import keep_facts

# Labels and spelling corrections.
POS_STATUS = {1: "Open", 0: "Close"}
SSSG_LABELS = {1: "SSSG", 0: "Non SSSG"}
REGION_WORDS = {"Ntt": "NTT", "Ntb": "NTB", "Dki": "DKI"}
PROVINCES = {
    "Jawa Tenga": "Jawa Tengah",
    "Di Yogyaka": "DI Yogyakarta",
    "Dki Jakarta": "DKI Jakarta",
    "Sumatera S": "Sumatera Selatan",
    "Sulawesi T": "Sumatera Tengah",
    "Nusa Tengg": "Nusa Tenggara",
    "Sulawesi U": "Sulawesi Utara",
    "Bangka Bel": "Bangka Belitung",
    "Maluku Uta": "Maluku Utara",
    "Sulawesi S": "Sulawesi Selatan",
}
COMPANY_KEYS = {"mpr": 1}
OTHER_COMPANY_KEY = 2

# ERP heading to dimension column.
ERP_COLUMNS = {
    "Whcode": "WarehouseKey", "OpenStatus": "StoreDynamicsStatus", "Brand": "BrandKey",
    "AxCode": "StoreCode", "MdsCode": "StoreMdsCode", "Sssg": "StoreSssg", "StdName": "StoreName",
    "MainChannel": "StoreMainChannel", "Channel": "StoreChannel", "Region": "StoreRegion",
    "Province": "StoreProvince", "City": "StoreCity", "Address": "StoreAddress", "Sqm": "StoreSqm",
}
# Column names that readers expect.
DIMENSION = (
    "company_key", "store_pos_id", "store_dynamics_id", "warehouse_key", "store_pos_status",
    "store_dynamics_status", "brand_key", "store_code", "store_invoice_code", "store_mds_code",
    "store_sssg", "store_name", "store_main_channel", "store_channel", "store_country",
    "store_region", "store_province", "store_city", "store_address", "store_sqm",
    "store_sync_status", "current_status",
)


def store_dimension(erp: DataFrame, pos: DataFrame) -> DataFrame:
    """ERP stores with their POS counterpart, labels and corrected place names."""
    counterpart = pos.select(
        F.col("id").alias("StorePosID"),
        F.col("extCode").alias("StoreCode"),
        map_values(F.col("status").cast("int"), POS_STATUS).alias("StorePosStatus"),
    )
    renamed = erp.withColumnsRenamed(ERP_COLUMNS)
    joined = keep_facts(renamed, counterpart, ["StoreCode"])
    region = title_case("StoreRegion")
    for old, new in REGION_WORDS.items():
        region = F.replace(region, F.lit(old), F.lit(new))
    same = F.coalesce(F.col("StoreDynamicsStatus") == F.col("StorePosStatus"), F.lit(False))
    labelled = joined.withColumns(
        {
            "StoreSssg": map_values(F.col("StoreSssg").cast("int"), SSSG_LABELS),
            "StoreRegion": region,
            "StoreProvince": replace_values(title_case("StoreProvince"), PROVINCES),
            "StoreCity": delete(title_case("StoreCity"), "Kota "),
            "StoreAddress": clean_address("StoreAddress"),
            "StoreCountry": F.lit("Indonesia"),
            "StoreDynamicsID": F.lit(None).cast("string"),
            "StoreInvoiceCode": F.lit(None).cast("string"),
            "StoreSyncStatus": F.when(same, F.lit("Yes")).otherwise(F.lit("No")),
            "CompanyKey": company_key(F.col("DataAreaId")),
            "CurrentStatus": F.lit("current"),
        }
    )
    return rename_all(labelled, camel_to_snake).select(*DIMENSION)


def company_key(company: Column) -> Column:
    return F.coalesce(map_values(company, COMPANY_KEYS), F.lit(OTHER_COMPANY_KEY))


def initial_load(dimension: DataFrame, as_of: Column) -> DataFrame:
    """First version of the dimension: open-ended validity from ``as_of``."""
    return dimension.withColumns(
        {
            "start_date": as_of,
            "end_date": F.lit(None).cast("date"),
            "create_date": as_of,
            "update_date": as_of,
        }
    )
