"""Names, levels and constants that decide the results."""

# CSV tokens read as NULL. "missing" is a category, not a NULL.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "na", "nan", "null",
]

# Typed columns of the policy table. The id is wide, so that more rows than
# an int can number still get distinct ids.
POLICY_COLUMNS = {
    "id": "bigint",
    "12m_call_history": "int",
    "acq_method": "string",
    "ann_prm_amt": "double",
    "bi_limit_group": "string",
    "channel": "string",
    "digital_contact_ind": "int",
    "geo_group": "string",
    "has_prior_carrier": "int",
    "home_lot_sq_footage": "double",
    "household_group": "string",
    "household_policy_counts": "int",
    "newest_veh_age": "int",
    "pay_type_code": "string",
    "pol_edeliv_ind": "int",
    "prdct_sbtyp_grp": "string",
    "product_sbtyp": "string",
    "telematics_ind": "int",
    "tenure_at_snapshot": "int",
    "trm_len_mo": "int",
}
ID = "id"
TARGET = "call_counts"
NONZERO = "nonzero_call"

# Segment markers and the columns each segment leaves out.
NOT_AUTO = "NonAuto"
NO_TELEMATICS = -2
SEGMENT_DROPS = {
    "auto": ["trm_len_mo", "channel"],
    "nonauto": ["bi_limit_group", "newest_veh_age", "telematics_ind"],
}
SEGMENTS = {"auto": "Auto", "nonauto": "NonAuto"}

# Imputation of the e-delivery flag.
IMPUTED = "pol_edeliv_ind"
FILLED = "pol_edeliv_ind_filled"
SENTINEL = -2
KNOWN_FLAGS = [0, 1, -1]
NEIGHBOURS = 5
KNN_NUMERIC = ["12m_call_history", "ann_prm_amt", "household_policy_counts", "tenure_at_snapshot"]
KNN_FLAGS = ["digital_contact_ind", "has_prior_carrier"]
GEO_LEVELS = ["rural", "suburban", "urban"]

# Split fraction and seed.
HOLDOUT = 0.2
SEED = 42

# Caps and knots of the feature views.
HISTORY_CAP = {"auto": 40, "nonauto": 30}
PREMIUM_CAP = 7200
TENURE_CAP = 500
TENURE_KNOT = 300
POLICY_COUNT_CAP = {"auto": 4, "nonauto": 5}
POLICY_COUNT_KNOT = {"auto": 2, "nonauto": 3}
RETAIL = "Retail"
LONG_TERM = 12
HOUSEHOLD_FLAG = {"auto": "2autodwelling", "nonauto": "1dwelling"}

# Grid widths of the level tables.
HISTORY_BIN = 5
PREMIUM_BIN = 900
LOT_BIN = 10000
TENURE_BIN = 100

# Nominal columns of the encoders.
NOMINAL = {
    "auto": ["acq_method", "bi_limit_group", "geo_group", "pol_edeliv_ind",
             "prdct_sbtyp_grp", "product_sbtyp", "telematics_ind"],
    "nonauto": ["acq_method", "geo_group", "pol_edeliv_ind", "prdct_sbtyp_grp", "product_sbtyp"],
}

# Standardised columns of the encoders.
NUMERIC = {
    ("baseline", "auto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                           "household_policy_counts", "newest_veh_age", "tenure_at_snapshot"],
    ("baseline", "nonauto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                              "household_policy_counts", "tenure_at_snapshot"],
    ("binary", "auto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                         "household_policy_counts_le2", "household_policy_counts_gt2",
                         "newest_veh_age", "tenure_at_snapshot"],
    ("binary", "nonauto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                            "household_policy_counts", "tenure_at_snapshot"],
    ("count", "auto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                        "household_policy_counts_le2", "household_policy_counts_gt2",
                        "newest_veh_age", "tenure_at_snapshot"],
    ("count", "nonauto"): ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage",
                           "household_policy_counts_le3", "household_policy_counts_gt3",
                           "tenure_at_snapshot_le300", "tenure_at_snapshot_gt300"],
}

# Variables of the level and calibration tables.
LEVEL_VARIABLES = {
    "auto": ["binned_12m_call_history", "acq_method", "binned_ann_prm_amt", "bi_limit_group",
             "digital_contact_ind", "geo_group", "has_prior_carrier", "binned_home_lot_sq_footage",
             "household_group", "capped_household_policy_counts", "newest_veh_age", "pay_type_code",
             "pol_edeliv_ind_filled", "prdct_sbtyp_grp", "product_sbtyp", "telematics_ind",
             "binned_tenure_at_snapshot"],
    "nonauto": ["binned_12m_call_history", "acq_method", "binned_ann_prm_amt", "digital_contact_ind",
                "geo_group", "has_prior_carrier", "binned_home_lot_sq_footage", "household_group",
                "capped_household_policy_counts", "pay_type_code", "pol_edeliv_ind_filled",
                "prdct_sbtyp_grp", "product_sbtyp", "trm_len_mo", "binned_tenure_at_snapshot"],
}

# Columns drawn as boxes and as bars when the segments are compared.
BOX_COLUMNS = ["12m_call_history", "ann_prm_amt", "home_lot_sq_footage", "newest_veh_age",
               "tenure_at_snapshot"]
BAR_COLUMNS = ["household_policy_counts", "acq_method", "bi_limit_group", "channel",
               "digital_contact_ind", "geo_group", "has_prior_carrier", "household_group",
               "pay_type_code", "pol_edeliv_ind_filled", "prdct_sbtyp_grp", "product_sbtyp",
               "telematics_ind", "trm_len_mo"]
LOG_CAPS = {
    "12m_call_history": {"auto": 40, "nonauto": 30},
    "ann_prm_amt": {"auto": 7200, "nonauto": 7200},
    "tenure_at_snapshot": {"auto": 500, "nonauto": 500},
}
HISTOGRAM_BINS = 30

# Stepwise selection thresholds.
ENTER_P = 0.01
LEAVE_P = 0.05
