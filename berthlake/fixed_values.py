"""Data that must be equal to the published definitions.

Everything in this file is a value table (names, header spellings, constants), not logic.
"""

# Terminal number -> display name.
TERMINAL_NAMES = {
    1: "PNIT",
    2: "PNC",
    3: "HJNC",
    4: "HPNT",
    5: "BNCT",
    6: "BCT",
    7: "DGT",
}

# Leading file-name token -> terminal number.
FILE_TOKEN_TO_TERMINAL = {
    "pnit": 1,
    "pnc": 2,
    "hjnc": 3,
    "hpnt": 4,
    "bnct": 5,
    "bct": 6,
    "dgt": 7,
}

# Header rule per terminal: index of the header row, None where the table has no header.
# Terminal 6 is the XML dataset, whose column ids are delivered as row 0.
HEADER_ROW = {1: None, 2: None, 3: 1, 4: None, 5: 0, 6: 0, 7: 0}

# Source header -> canonical column, one table per terminal, in source order.
DROP = "_drop"
WORKLOAD = "_workload"
COLUMN_MAPS = {
    1: {
        "col_1": "berth",
        "col_2": "carrier",
        "col_3": "mother_vessel",
        "col_4": "sun_vessel",
        "col_5": "head_bridge_stern",
        "col_6": "vessel_name",
        "col_7": "route",
        "col_8": "closing",
        "col_9": "eta",
        "col_10": "etd",
        "col_11": "discharge",
        "col_12": "loading",
        "col_13": "shift",
        "col_14": "amp",
        "col_15": "status",
    },
    2: {
        "col_1": DROP,
        "col_2": "vessel_name",
        "col_3": "mother_vessel",
        "col_4": "sun_vessel",
        "col_5": "carrier",
        "col_6": "route",
        "col_7": "head_bridge_stern",
        "col_8": "eta",
        "col_9": "etd",
        "col_10": "berth",
        "col_11": "closing",
        "col_12": "discharge",
        "col_13": "loading",
        "col_14": "shift",
        "col_15": DROP,
        "col_16": DROP,
        "col_17": DROP,
    },
    3: {
        "No": DROP,
        "선석": "berth",
        "항로": "route",
        "모선항차": "mother_vessel",
        "선박명": "vessel_name",
        "선사항차": "sun_vessel",
        "접안": DROP,
        "선사": "carrier",
        "반입 시작일시": DROP,
        "반입 마감일시": "closing",
        "입항일시": "eta",
        "출항일시": "etd",
        "작업 시작일시": DROP,
        "작업 완료일시": DROP,
        "양하": "discharge",
        "선적": "loading",
        "S/H": "shift",
        "전배": DROP,
    },
    4: {
        "col_1": "berth",
        "col_2": "carrier",
        "col_3": "mother_vessel",
        "col_4": "sun_vessel",
        "col_5": "vessel_name",
        "col_6": "route",
        "col_7": DROP,
        "col_8": "eta",
        "col_9": "etd",
        "col_10": DROP,
        "col_11": "closing",
        "col_12": "discharge",
        "col_13": "loading",
        "col_14": "shift",
        "col_15": "amp",
        "col_16": "status",
    },
    5: {
        "선석": "berth",
        "선사": "carrier",
        "모선항차(선사항차)\nHead (Bridge) Stern": DROP,
        "선명\n(ROUTE)": "vessel_name",
        "반입마감시한": "closing",
        "접안(예정)일시": "eta",
        "출항(예정)일시": "etd",
        "작업량\n양하 / 적하 / Shift": WORKLOAD,
        "상태": "status",
    },
    6: {
        "plvBerth": "berth",
        "cdvOperator": "carrier",
        "plvVslvoy": "mother_vessel",
        "cdvName": "vessel_name",
        "plvEvoyout": "sun_vessel",
        "plvRoute": "route",
        "plvAtb": "eta",
        "plvAtd": "etd",
        "plvDisvan": "discharge",
        "plvLodvan": "loading",
        "plvShiftvan": "shift",
        "plvStatus": "status",
    },
    7: {
        "선석": "berth",
        "선사코드": "carrier",
        "모선항차(선사항차)": "mother_vessel",
        "모선명(Route)": "vessel_name",
        "반입마감시한": "closing",
        "접안예정일시": "eta",
        "출항예정일시": "etd",
        "작업시작시간": DROP,
        "작업완료시간": DROP,
        "Head (Bridge) Stern": "head_bridge_stern",
        "작업량\n양하/적하/Shift": WORKLOAD,
        "상태": "status",
    },
}

# Normalised header spelling -> canonical column, for the yearly history files.
HISTORY_SYNONYMS = {
    "접안(예정)일시": "eta",
    "접안예정시간": "eta",
    "접안일시": "eta",
    "입항일시": "eta",
    "atb": "eta",
    "arrival": "eta",
    "접안예정시간(etb)": "eta",
    "접안예정일시": "eta",
    "출항(예정)일시": "etd",
    "출항예정시간": "etd",
    "출항일시": "etd",
    "atd": "etd",
    "departure": "etd",
    "출항예정시간(etd)": "etd",
    "출항예정일시": "etd",
    "선석": "berth",
    "berth": "berth",
    "선명": "vessel_name",
    "모선명": "vessel_name",
    "선박명": "vessel_name",
    "vessel": "vessel_name",
    "모선항차": "mother_vessel",
    "선사항차": "sun_vessel",
    "head(bridge)stern": "head_bridge_stern",
    "반입마감시한": "closing",
    "반입마감시간": "closing",
    "양하": "discharge",
    "discharge": "discharge",
    "import": "discharge",
    "양하수량": "discharge",
    "적하": "loading",
    "선적": "loading",
    "load": "loading",
    "export": "loading",
    "선적수량": "loading",
    "적하수량": "loading",
    "상태": "status",
    "status": "status",
    "선사": "carrier",
    "운항선사": "carrier",
    "선사코드": "carrier",
    "route": "route",
    "항로": "route",
    "route명": "route",
    "amp": "amp",
    "shift": "shift",
    "s/h": "shift",
    "이적": "shift",
}
HISTORY_HEADER_WORDS = ["선석", "입항", "출항", "양하", "적하", "선적", "접안", "모선", "선명", "선박"]
HISTORY_WORKLOAD_WORD = "작업량"
HISTORY_FILE_WORD = "부두"

# Canonical silver columns in table order.
SILVER_COLUMNS = [
    "terminal_id", "terminal_name", "snapshot_id", "bronze_row_id", "source_file_name",
    "source_row_number", "row_hash", "parsed_at", "eta_work_date", "business_key",
    "berth", "carrier", "vessel_name", "mother_vessel", "sun_vessel", "head_bridge_stern",
    "route", "eta", "etd", "closing", "discharge", "loading", "shift", "amp", "status",
    "is_valid", "error_msg",
    "eta_date", "total_workload", "eta_hour", "eta_dayofweek", "is_amp",
]

# Monthly container sheet: column order after the sub-header row is removed.
MONTHLY_COLUMNS = [
    "month",
    "total_full", "total_empty",
    "import_full", "import_empty",
    "export_full", "export_empty",
    "import_transship_full", "import_transship_empty",
    "export_transship_full", "export_transship_empty",
]
MONTHLY_FILE_NAME = "월별 컨테이너 처리실적(확정)_{year}.xlsx"

# Cell texts that stand for a missing value.
NULL_TOKENS = ["", "nan", "None"]

# Characters that are replaced by "_" in column names.
ILLEGAL_NAME_CHARS = " ;{}()\n\t="

# Rows that are no vessel calls.
EXCLUDED_NAME_PATTERN = "STORAGE|DUMMY|공컨|테스트|TEST"
CANCELLED_STATUS = ["CANCELLED", "CANCELED"]
INVALID_ROW_MESSAGE = "선석/선명 모두 없음"
UNKNOWN_VESSEL_PREFIX = "미확인 선박("

# Month -> seasonal weight of the volume.
SEASON_WEIGHTS = {
    1: 1.0087, 2: 0.9362, 3: 1.0504, 4: 1.0302, 5: 1.0615, 6: 0.9980,
    7: 1.0317, 8: 0.9875, 9: 0.9393, 10: 0.9823, 11: 0.9871, 12: 0.9870,
}
# Month -> transshipment share (percent) used where no actual value exists.
TRANSSHIP_DEFAULTS = {
    1: 64.2, 2: 64.1, 3: 64.3, 4: 64.4, 5: 64.5, 6: 64.3,
    7: 64.2, 8: 64.0, 9: 64.1, 10: 64.2, 11: 64.3, 12: 64.4,
}
TRANSSHIP_LAST_RESORT = 64.0
OCCUPANCY_LAST_RESORT = 50.0
FREIGHT_CATEGORY = "SCFI"

# Two-week period -> month.
BIWEEK_TO_MONTH = {
    1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3, 7: 4, 8: 4, 9: 5, 10: 5, 11: 6, 12: 6, 13: 6,
    14: 7, 15: 7, 16: 8, 17: 8, 18: 9, 19: 9, 20: 10, 21: 10, 22: 11, 23: 11,
    24: 12, 25: 12, 26: 12,
}

# Stays of this many hours or more are data errors.
MAX_STAY_HOURS = 240.0

# Features of the forecast model in model order, and the operational subset.
FEATURES = [
    "weight", "transship_ratio", "index_mom", "berth_occupancy", "lag_adj",
    "rolling_yoy", "vessel_count", "avg_dwell", "shift_ratio", "season_sin", "season_cos",
]
OPERATIONAL_FEATURES = [
    "vessel_count", "avg_dwell", "berth_occupancy", "shift_ratio", "transship_ratio",
]
# Last value of the fall-back chain of an operational feature.
FEATURE_LAST_RESORT = {
    "vessel_count": 10.0,
    "avg_dwell": 24.0,
    "berth_occupancy": 50.0,
    "shift_ratio": 0.0,
    "transship_ratio": 64.0,
}
# The same for the transshipment share of terminals that are not projected.
FLAT_SHARE_LAST_RESORT = 0.0

# Model parameters.
RIDGE_ALPHA = 50.0
TREE_COUNT = 30
TREE_DEPTH = 3
TREE_STEP = 0.08
TREE_L1 = 1.0
TREE_L2 = 1.0
SCENARIO_STEP = {"Flat": 0.0, "Rise": 0.05, "Fall": -0.05}
MONTH_HORIZON = 18
BIWEEK_HORIZON = 39
