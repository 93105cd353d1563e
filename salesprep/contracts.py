"""Fixed input and output layouts.

Codes are strings everywhere: an inferred number would lose leading zeros and
would clash with a string code in joins and unions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


SALES = T.StructType(
    [
        T.StructField("year_month", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("store_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("product_sku_code", T.StringType()),
        T.StructField("outlet_category_name", T.StringType()),
        T.StructField("category_desc", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("metro", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("yago", T.StringType()),
        T.StructField("beat_code", T.StringType()),
        T.StructField("value_sales", T.DoubleType()),
        T.StructField("vol_sales", T.DoubleType()),
        T.StructField("rr", T.StringType()),
        T.StructField("num_invoices", T.IntegerType()),
    ]
)

# Column names of the two published tables, by position.
HISTORY_NAMES = (
    "Year_Month",
    "City",
    "Store_Code",
    "Brand",
    "Product_SKU_Code",
    "Outlet_category_name",
    "Category_Desc",
    "Address",
    "Metro",
    "Region",
    "Bucket",
    "YAGO",
    "Beat_Code",
    "ValueSales",
    "VolSales",
    "RR",
    "NUM_INVOICES",
)
EXTRACT_NAMES = tuple(f"V{position}" for position in range(1, 18))

# Header names of the input files.
RAW_EXTRACT = _strings(
    "Year_Month",
    "Distributor Code",
    "Distributor Name",
    "Store Code",
    "DB Channel",
    "Channel Local",
    "ASM",
    "Restated Store Code",
    "Outlet Unique Code",
)
POS_FILE = _strings("POSCode", "POSDesc", "PartnerCode", "POSStatus", "SalesRepCode", "SalesRepName")
AREA_FILE = _strings("RB_CUST_CODE", "CUSTOM_ATTR14")
DISTRIBUTOR_FILE = _strings("DB")
RESTRICTED_FILE = _strings("Material")
ROUTE_FILE = _strings("StoreID", "Sales Representative ID")

# Names used inside the library for the file columns above.
POS_NAMES = ("pos_code", "pos_desc", "partner_code", "pos_status", "sales_rep_code", "sales_rep_name")
AREA_NAMES = ("partner_code", "new_area")
DISTRIBUTOR_NAMES = ("distributor_code",)
RESTRICTED_NAMES = ("material",)
ROUTE_NAMES = ("store_id", "sales_rep_id")


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged, or raise when a contract column is absent or has another type.

    Extra columns are allowed. Metadata only, no job.
    """
    found = {field.name: field.dataType for field in df.schema}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'nothing'}"
        for field in contract
        if found.get(field.name) != field.dataType
    ]
    if problems:
        raise ValueError("input does not meet its contract: " + "; ".join(problems))
    return df
