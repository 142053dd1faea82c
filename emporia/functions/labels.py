"""Dimension labels: age group, gender name, KPI names, topic names.

Fixed values: these strings must equal the reference's output exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's) -------------------------------
AGE_UNDER_20 = "20岁及以下"
AGE_OVER_30 = "30岁以上"
AGE_21_TO_30 = "21岁到30岁"
GENDER_MALE = "男"
GENDER_FEMALE = "女"
KPI_DAU_NAME = "新增日活"
KPI_NEW_MID_NAME = "新增设备"
KPI_ORDER_AMOUNT_NAME = "新增交易额"
TOPIC_CDC_PREFIX = "ODS_T_"
YEAR_DAYS = 365
# -------------------------------------------------------------------------------

# Topic names: deployment configuration (the startup/event split and the
# layer names are what matters, not the exact strings).
TOPIC_STARTUP = "APP_STARTUP"
TOPIC_EVENT = "APP_EVENT"
TOPIC_DWD_ORDER_INFO = "DWD_ORDER_INFO"
TOPIC_DWD_ORDER_DETAIL = "DWD_ORDER_DETAIL"
TOPIC_DWS_ORDER_WIDE = "DWS_ORDER_WIDE"

# The default "as of" date for ages in batch queries: a parameter, never the clock.
DEFAULT_AS_OF = "2024-01-31"


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole years as the reference counts them: elapsed days // 365."""
    return F.floor(F.datediff(as_of, birthday) / F.lit(YEAR_DAYS)).cast("long")


def age_group(birthday: Column, as_of: Column) -> Column:
    """< 20 -> under-20 label; > 30 -> over-30 label; else the middle label
    (so age 20 and 30 land in the middle group, as written)."""
    age = age_years(birthday, as_of)
    return (
        F.when(age < 20, F.lit(AGE_UNDER_20))
        .when(age > 30, F.lit(AGE_OVER_30))
        .when(age.isNotNull(), F.lit(AGE_21_TO_30))
    )


def gender_name(gender: Column) -> Column:
    """``M`` -> male label, anything else (null included) -> female label."""
    return F.when(gender.eqNullSafe(F.lit("M")), F.lit(GENDER_MALE)).otherwise(F.lit(GENDER_FEMALE))


def cdc_topic(table: Column) -> Column:
    return F.concat(F.lit(TOPIC_CDC_PREFIX), F.upper(table))
