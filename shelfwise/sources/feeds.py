"""The seven delivered feeds as declared feed specs (SURVEY C1, C2, P7, P9,
S2, S9) and the job that runs them: one call over a drop folder publishes every
table and the merged catalogue.

Workbooks enter as CSV exports of the named sheet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import scalars as S
from shelfwise.operators import ingest as I
from shelfwise.operators import schema as P
from shelfwise.operators.dedupe import first_per_key
from shelfwise.operators.ingest import FeedSpec
from shelfwise.sources import sinks as SK

# Declared columns of each feed, "name | type", in file order.
WEBSITE = """
day | timestamp_ntz
week | string
oms id + | int
online upc cd + | string
online product interaction conversion rate | float
online product interaction conversion rate ly | float
online pip conversion rate + | float
online pip conversion rate ly + | float
online display avg rating + | float
online display count of 1 star reviews + | float
online display count of 2 star reviews + | float
online display count of 3 star reviews + | float
online display count of 4 star reviews + | float
online display count of 5 star reviews + | float
online non-buyable views + | float
online non-buyable views ly + | float
online current cost $ + | float
online pip visits + | float
online pip visits ly + | float
online product interaction visits + | float
online product interaction visits ly + | float
order count TY | float
order count LY | float
"""
SALES = """
day | timestamp_ntz
fulfillment channel + | string
fulfillment channel name + | string
icr store + | string
online upc + | string
week | string
oms id + | int
online sales $ + | float
online sales $ ly + | float
online cancel units + | int
online cancel units ly + | int
online count of orders + | int
online count of orders ly + | int
online gross demand $ + | float
online gross demand $ ly + | float
online order units + | int
online order units ly + | int
online return $ + | float
online return $ ly + | float
online return units + | float
online return units ly + | int
online sales $ before returns + | float
online sales $ before returns ly + | float
online settled units + | int
online settled units before returns + | int
online settled units before returns ly + | int
online settled units ly+ | int
"""
CLASSIFICATION = """
oms id + | int
online class + | string
online merch dept + | string
online subclass + | string
internet sku name + | string
online merch dept nbr + | string
online classification + | string
online disposition | string
online ship from type + | string
online ship lead days | string
online upc + | string
"""
SCORECARD = """
TOTAL SCORE | float
# ENRICHMENTS | int
OMSID | int
CLASS BAND | string
MFG MODEL | string
VENDOR NAME | string
MFG BRAND NAME | string
ALT IMAGES #  | bigint
ALT IMAGES TARGET | int
 | string
DOCS #  | bigint
_duplicated_0 | string
DOCS TARGET | int
VIDEOS #  | bigint
_duplicated_1 | string
VIDEOS TARGET | int
_duplicated_2 | string
SALIENT BULLETS #  | bigint
_duplicated_3 | string
SALIENT BULLETS TARGET | int
AUGMENTED REALITY Y/N | string
_duplicated_4 | string
_duplicated_5 | string
_duplicated_6 | string
_duplicated_7 | string
_duplicated_8 | string
_duplicated_9 | string
AUGMENTED REALITY TARGET | string
_duplicated_10 | string
_duplicated_11 | string
360 SPIN Y/N | string
_duplicated_12 | string
_duplicated_13 | string
360 SPIN TARGET | string
REVIEWS #  | bigint
_duplicated_14 | string
REViEWS TARGET | bigint
SSKU Y/N | string
_duplicated_15 | string
_duplicated_16 | string
SSKU TARGET | string
NODE NAME | string
_duplicated_17 | string
SUB DEPT | string
_duplicated_18 | string
CLASS | string
SUB CLASS | string
PRODUCT NAME 120 | string
"""
STORES = """
icr byo name + | string
icr byo nbr + | int
icr buying office + | string
icr city + | string
icr county + | string
icr district  + | string
icr district name + | string
icr district nbr + | int
icr division + | string
icr division name + | string
icr division nbr + | int
icr latitude + | double
icr longitude + | double
icr market name + | string
icr market nbr + | int
icr store name + | string
icr store nbr + | string
icr postal code + | string
icr region  + | string
icr region name + | string
icr region nbr + | int
icr state territory code + | string
icr market + | string
"""
CALENDAR = """
week | string
"""
FG_STATUS = """
External | string
Basic San | string
Wse | string
Plt | string
Dpt | string
Pln Ctr | string
GroupNbr | string
Cls Cd | string
Lf Cycle | string
Color | string
Finish | string
BU | string
BU Name | string
M P G | string
MPG Name | string
IPG | string
IPG Name | string
Mkt Cls | string
Mkt Cls Desc | string
Prd Mgr | string
Top Cust Ct | string
Top Custs | string
Sft Inv Method | string
ABC Cd | string
ABC Flg | string
Sft Tm | float
Lead Tm Wks | int
Fcst Flg | string
Plt Pln Min | int
Plt Lot Size | int
Std Pk | int
Inn Pk | string
UPC | string
Cart | string
Pal Qty | int
Pal % | float
Cube | float
Length | float
Width | float
Height | float
Weight | float
On Hand | int
In Transit | int
QA Hold | int
Cust Ords | int
Net Inv | int
Tgt | int
Avg Wkly Dmd (6Mth) | float
Avg Wkly Dmd (2Mth) | float
Avg Wkly Fcst (2Mth) | float
Avg Wkly Fcst (6Mth) | float
Sft Time Qty | int
Base SS Qty | int
Sft Stk Qty | int
Sanning Indicator | string
Excess Inv | int
Flag | string
Inv Short | int
Flag2 | string
Wks of Supp Tgt (St) | float
Wks of Supp Act (St) | float
ST Var | float
Wks of Supp Tgt (Lt) | float
Wks of Supp Act (Lt) | float
LT Var | float
Dmd / Fcst | float
Notes | string
EAU Units | int
WOS | float
Basic | string
Dash | string
San | string
Basic-Dash | string
"""


def columns(text: str) -> dict[str, str]:
    """Declared columns of a feed: name -> Spark type (names keep their blanks)."""
    return dict(line.rsplit(" | ", 1) for line in text.strip("\n").split("\n"))


def _spec(text: str) -> tuple[dict, tuple]:
    """(types, date columns) of a feed for reading."""
    every = columns(text)
    dates = tuple(c for c, t in every.items() if t == "timestamp_ntz")
    return {c: t for c, t in every.items() if c not in dates}, dates


def website_steps(df: DataFrame) -> DataFrame:
    """Both order counts, as visits times conversion rate."""
    pairs = {"order count TY": ("online pip visits +", "online pip conversion rate +"),
             "order count LY": ("online pip visits ly +", "online pip conversion rate ly +")}
    known = {n: p for n, p in pairs.items() if set(p) <= set(df.columns)}
    return P.derive_order_counts(df, known)


def classification_steps(df: DataFrame) -> DataFrame:
    """Codes of twelve characters, then the first row per item of each file."""
    return first_per_key(df.filter(F.length(F.col("online upc +")) == 12), ["_file", "oms id +"], ["_row"])


def fg_status_steps(df: DataFrame) -> DataFrame:
    """Basic-Dash, then the first row per UPC of each file."""
    return first_per_key(df.withColumn("Basic-Dash", S.concat_code("Basic", "Dash")), ["_file", "UPC"], ["_row"])


FG_ROWS = (15000, 20000)      # fixed values: rows of a finished-goods report


def feed_specs() -> list[FeedSpec]:
    def make(name, prefix, text, **more):
        types, dates = _spec(text)
        return FeedSpec(name, prefix, types, dates, **more)
    day_item = ("day", "oms id +")
    return [
        make("online_website_anaylsis", "pythononlinewebsiteanalysis", WEBSITE, keys=day_item, steps=(website_steps,),
             rename={"online product interaction conversion rate ": "online product interaction conversion rate"}),
        make("online_sales", "pythononlinesales", SALES, keys=day_item, widen={"online return units +": "float"}),
        make("online_classification", "pythononlineclassification", CLASSIFICATION, steps=(classification_steps,)),
        make("BA_scorecard", "ba scorecard", SCORECARD, header_row=28),
        make("online_stores", "onlinestores", STORES),
        make("calendar", "pythoncalendar", CALENDAR),
        make("fg_status", "fg status report", FG_STATUS, steps=(fg_status_steps,), expected_rows=FG_ROWS),
    ]


FG_FIELDS = ("M P G", "MPG Name", "IPG", "IPG Name", "Prd Mgr", "Basic-Dash")


def merge_catalogue(classification: DataFrame, fg: DataFrame) -> DataFrame:
    """The catalogue with the finished-goods fields of the code's first
    eleven characters; one row per item (of several matches the smallest UPC)."""
    right = fg.select(F.col("UPC").cast("string").alias("_fg"), *[F.col(f"`{c}`") for c in FG_FIELDS])
    j = classification.join(right, S.prefix(F.col("online upc +"), 11) == F.col("_fg"), "left")
    return first_per_key(j, ["oms id +"], ["_fg"]).drop("_fg")


def run(spark: SparkSession, drop_dir: str, tables_dir: str, conditions: dict | None = None) -> DataFrame:
    """Ingest every feed, publish the merged catalogue, return the audit."""
    audit = I.ingest(spark, drop_dir, tables_dir, feed_specs(), conditions)
    parts = [SK.read_published(spark, f"{tables_dir}/{t}") for t in ("online_classification", "fg_status")]
    if all(p is not None for p in parts):
        SK.publish(merge_catalogue(*parts), f"{tables_dir}/merged_classification")
    return audit
