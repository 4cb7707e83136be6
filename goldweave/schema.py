"""Column lists and schemas of the item tables, stated once.

Every other module derives what it needs from these lists by set difference;
none repeats column names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the item feed's columns --------------------------------
KEYS = ["item_id", "revision"]

OFFSET_DATES = [
    "eol_date", "setup_date", "user_date", "source_item_mod_date",
    "source_c_item_mod_date", "eff_end_date", "eff_start_date",
]

MEASURES = [
    "height", "length", "weight", "width",
    "list_price", "unit_cost", "min_qty", "quantity_multiple",
]

TRIMMED = ["commodity_code"]

UNITS = ["height_um", "length_um", "weight_um", "width_um", "uom", "acc_uom", "currency_id"]

CODES = [
    "hazard", "hpl", "deleted", "mat_spec", "mil_spec", "type_", "text_lastseq",
    "user_alpha1", "user_alpha3", "record_id", "unid", "part_status", "product_code",
    "fld_srvc_spare_flag", "forecast_flag", "ship_tracking_code", "alternate_part_flag",
    "local_bill_flag", "print_on_traveler_flag", "box_code", "relief_exception_flag",
    "monitor_code", "ecn", "source_c_item_mod_user", "system_flag", "unspcs", "item_type",
    "category", "is_virtual", "item_level", "life_cyc_stg", "lot_serial_managed", "mfgr_id",
    "mfr_item_desc", "mfr_item_id", "name", "description", "org_id", "status",
    "sub_category", "commodity_id", "gtc", "pc", "fgc", "part_type", "part_class",
    "is_emc", "emc_part_ref", "design_type", "zmod",
]

OWNERSHIP = ["sys_source", "sys_ent_state", "sys_created_by", "sys_last_modified_by"]

CREATED = "sys_creation_date"
MODIFIED = "sys_last_modified_date"

# --- fixed values: what a change message carries --------------------------
# message column -> master column
MESSAGE_TO_MASTER = {
    "item": "item_id",
    "part_type": "part_type",
    "part_class": "part_class",
    "item_description": "description",
    "technical_process_desc": "technical_process_desc",
    "technical_vendor": "technical_vendor",
    "iso_ctry_code": "fga_iso_ctry_code",
    "life_cycle_state": "life_cycle_state",
    "life_cycle_rev_date": "life_cycle_rev_date",
    "reason_for_obsolete": "reason_for_obsolete",
    "technical_model_name": "technical_model_name",
    "vendor_processor_type": "vendor_processor_type",
    "lob_affected": "lob_affected",
    "processor_part_create_date": "processor_part_create_date",
    "item_config_id": "item_config_id",
}
MESSAGE_DATES = ["life_cycle_rev_date", "processor_part_create_date"]

# Set by the feed on first insert only: (mode A), and the two left out of mode B.
FIRST_WRITER_A = ["description", "commodity_id", "part_type", "part_class", "sys_created_by"]
NOT_IN_B = ["part_type", "part_class"]

# Constants of a master row born from a change message.
NO_REVISION = " "
MESSAGE_ITEM_TYPE = "PART"
ACTIVE = "ACTIVE"
DELETED = "DELETED"
# The largest transaction sequence; the next one starts again at 0.
SEQUENCE_LIMIT = 999999999
# --- end of fixed values ----------------------------------------------------

FEED_COLUMNS = KEYS + TRIMMED + OFFSET_DATES + MEASURES + UNITS + CODES + OWNERSHIP
MESSAGE_COLUMNS = list(MESSAGE_TO_MASTER.values())
MESSAGE_ONLY = [c for c in MESSAGE_COLUMNS if c not in FEED_COLUMNS]
STAMPS = [CREATED, MODIFIED]
MASTER_COLUMNS = FEED_COLUMNS + STAMPS + MESSAGE_ONLY

# Merge lists: what an update sets and what an insert sets.
FEED_A_INSERT = FEED_COLUMNS + STAMPS
FEED_A_UPDATE = [
    c for c in FEED_A_INSERT if c not in KEYS and c not in FIRST_WRITER_A and c != CREATED
]
FEED_B_INSERT = [c for c in FEED_A_INSERT if c not in NOT_IN_B]
FEED_B_UPDATE = FEED_A_UPDATE + ["description", "commodity_id"]
FEED_C_INSERT = FEED_B_INSERT
MESSAGE_UPDATE = [c for c in MESSAGE_COLUMNS if c != "item_id"] + [MODIFIED]
MESSAGE_INSERT = MESSAGE_COLUMNS + [
    "revision", "name", "item_type", "sys_created_by", CREATED,
    "sys_ent_state", "sys_last_modified_by", MODIFIED,
]
FLAG_COLUMNS = ["is_emc", "sys_source"]

_MEASURE = T.DecimalType(38, 10)


def _struct(columns: list[str], **special: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(c, special.get(c, T.StringType()), True) for c in columns]
    )


def _types(dates: T.DataType) -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {c: _MEASURE for c in MEASURES}
    types.update({c: dates for c in OFFSET_DATES})
    types.update({c: T.TimestampType() for c in STAMPS + MESSAGE_DATES})
    return types


FEED_SCHEMA = _struct(
    FEED_COLUMNS + ["transaction_seq"], **_types(T.StringType()), transaction_seq=T.LongType()
)
MESSAGE_SCHEMA = _struct(
    list(MESSAGE_TO_MASTER) + ["seq_num", "sys_creation_date"],
    **_types(T.StringType()),
    seq_num=T.LongType(),
)
MASTER_SCHEMA = _struct(MASTER_COLUMNS, **_types(T.TimestampType()))

REJECT_EXTRA = ["sys_err_code", "sys_err_mesg", "sys_nc_type", "item_class"]
# One shape for every step's rejects. Feed dates are kept as text: a rejected one
# may be one that does not parse.
REJECT_SCHEMA = T.StructType(
    _struct(MASTER_COLUMNS, **_types(T.StringType())).fields
    + [
        T.StructField("sys_err_code", T.LongType()),
        T.StructField("sys_err_mesg", T.StringType()),
        T.StructField("sys_nc_type", T.StringType()),
        T.StructField("item_class", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("sync_up_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("sync_up_date", T.TimestampType()),
        T.StructField("operation_code", T.LongType()),
        T.StructField("operation_status", T.StringType()),
        T.StructField("instance_id", T.StringType()),
    ]
)
JOB_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("job_frequency_per_day", _MEASURE),
    ]
)
PROPERTY_SCHEMA = _struct(["id", "propvalue", "proptype", "sys_ent_state"])
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("step_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("job_instance_id", T.StringType()),
        T.StructField("sync_up_id", T.StringType()),
        T.StructField("step_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_merged", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)
