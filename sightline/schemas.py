"""Event, warehouse and document schemas.

The names, orders and defaults in this module are fixed values: they are the formats of the
event feeds and of the tables they end up in, so they are listed as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw events, format 1 (times are yyyyMMddHHmmss digits) ---------------
# The feed also has `parttype`, which nothing uses and which Spark cannot tell from
# `partType`; it is left out.
EVENT_V1 = """
    id string, nodeId string, sourceId int, plateNumber string, plateTypeId int,
    locationId string, deviceId string, laneId int, speed int, captureTime bigint,
    passTime string, directionId string, colorId int, modelId int, imageUrl string,
    isSheltered int, isSafebelt int, isPhoneface int, locationuuid string, countyId int,
    levelId int, lastCaptured int, lastCapturedId string, brandId int, partType int,
    yearId int, coordinates string, regionCode int, hasTag int, hasZjh int, hasZsw int,
    remoteImageUrl string, checksum string, recYearId string, carBox string,
    recPlateNumber string, feature string, fakeplates int, realBrandId string,
    vinCode string, createTime bigint, phpCarBox string, dataSource string, groupId int,
    xidu int, jiujia int, zuijia int, zaitao int, zhongdian int, shean int, wuzheng int,
    weizhang int, yuqi int, gaoweidiqu int, teshugaowei int, right_nobelt_id int,
    left_nobelt_id int, right_phone_id int, right_img string, left_img string,
    manned_id_ int, dangerous_chemicals_id int, construction_truck_id_ int,
    ctruck_lid_id_ int, sendTime bigint, plateCategoryId int
"""

# --- fixed values: raw events, format 2 (times are epoch seconds) ------------------------
EVENT_V2 = """
    id string, locationuuid string, levelId int, yearId int, modelId int, brandId int,
    plateNumber string, regionCode int, captureTime bigint, nodeId string, partType int,
    colorId int, directionId string, plateTypeId int, plateCategoryId int,
    lastCaptured bigint, skylight int, baggageHold int, sprayWord int, inspectionTag int,
    sunShadeLeft int, sunShadeRight int, pendant int, tissueBox int, decoration int,
    card int, personLeft int, personRight int, backBurnerTail int, sendTime bigint,
    recPlateNumber string, locationId string, carBox string, imageUrl string, speed int,
    feature string, yearIdProb float
"""

# --- fixed values: warehouse row, column -> event field; dateid comes last ---------------
WAREHOUSE_FIELDS = {
    "solrid": "id",
    "platenumber": "plateNumber",
    "capturetime": "captureTime",
    "directionid": None,
    "colorid": "colorId",
    "modelid": "modelId",
    "brandid": "brandId",
    "levelid": "levelId",
    "yearid": "yearId",
    "recfeature": "feature",
    "locationid": "locationuuid",
    "lastcaptured": "lastCaptured",
    "issheltered": "isSheltered",
    "createtime": "createTime",
    "regioncode": "regionCode",
    "direction": "directionId",
}

# --- fixed values: the column list the two index builders read, in their order.
INDEX_COLUMNS = [
    "dateid", "recfeature", "yearid", "platenumber", "solrid", "capturetime", "direction",
    "colorid", "modelid", "brandid", "levelid", "locationid", "lastcaptured", "issheltered",
]

# --- fixed values: the fields packed into one location-time cell, in their order.
PACKED_PASS_FIELDS = [
    "yearid", "platenumber", "direction", "colorid", "modelid", "brandid", "levelid",
    "lastcaptured", "issheltered", "solrid",
]

# --- fixed values: coded document fields, code -> event field -----------------------------
DOCUMENT_V1 = {
    "A001": "id", "A002": "locationuuid", "A003": "levelId", "A004": "yearId",
    "A005": "modelId", "A006": "brandId", "A007": "plateNumber", "A008": "regionCode",
    "A009": "captureTime", "A011": "partType", "A012": "colorId", "A013": "directionId",
    "A014": "plateTypeId", "A015": "isSheltered", "A016": "fakeplates",
    "A017": "lastCaptured", "A018": "jiujia", "A019": "xidu", "A020": "zuijia",
    "A021": "zaitao", "A022": "zhongdian", "A023": "shean", "A024": "wuzheng",
    "A025": "yuqi", "A026": "gaoweidiqu", "A027": "teshugaowei", "A040": "weizhang",
    "S002": "createTime",
}

# Row-store columns of format 1 beyond the document; None is a constant empty string.
ROW_STORE_V1 = {
    **DOCUMENT_V1,
    "A033": "carBox", "A034": "imageUrl", "A036": "recPlateNumber", "A037": None,
    "A038": None, "A039": "locationId", "A052": "feature",
}

DOCUMENT_V2 = {
    "A001": "id", "A002": "locationuuid", "A003": "levelId", "A004": "yearId",
    "A005": "modelId", "A006": "brandId", "A007": "plateNumber", "A008": "regionCode",
    "A009": "captureTime", "A010": "nodeId", "A011": "partType", "A012": "colorId",
    "A013": "directionId", "A014": "plateTypeId", "A015": "plateCategoryId",
    "A016": "lastCaptured", "A017": "skylight", "A018": "baggageHold", "A019": "sprayWord",
    "A020": "inspectionTag", "A021": "sunShadeLeft", "A022": "sunShadeRight",
    "A023": "pendant", "A024": "tissueBox", "A025": "decoration", "A026": "card",
    "A027": "personLeft", "A028": "personRight", "A029": "backBurnerTail",
    "A030": "sendTime", "A031": "recPlateNumber", "A032": "locationId",
}

# Row-store columns of format 2 beyond the document.
ROW_STORE_V2 = {
    **DOCUMENT_V2,
    "A033": "carBox", "A034": "imageUrl", "A035": "speed", "A036": "feature",
}

# --- fixed values: defaults at the sinks ---------------------------------------------------
UNKNOWN_CODE = -1
UNKNOWN_TEXT = ""
UNKNOWN_REGION_V1 = -1
UNKNOWN_REGION_V2 = 0
# Marks inside an entity that mean "none" and "not recognised", and its length bounds.
ENTITY_MARKERS = ("无", "未")
ENTITY_LENGTH = (6, 10)
MAX_CLOCK_LEAD_SECONDS = 24 * 60 * 60
# The text some feeds write for a missing feature.
NULL_FEATURE_TEXT = "null"
# Which side of the object was seen.
PART_HEAD = 1
PART_TAIL = 2
# Last-seen thresholds of the two feeds, and the limits of the late branches.
SUPPRESS_SECONDS_V1 = 12 * 60
SUPPRESS_SECONDS_V2 = 12 * 60 * 60
LATE_SEARCH_SECONDS = 6 * 60
HISTORY_SECONDS = 60
# Documents per bulk request, which become rows per file.
DOCUMENTS_PER_FILE = 20_000
TOP_K = 100


def fields_of(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of a flat schema text, without a session."""
    return [tuple(part.split()) for part in ddl.split(",")]


def event_type(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def sink_defaults(schema: T.StructType, region: int = UNKNOWN_REGION_V2) -> dict[str, object]:
    """Default per column by type: codes -1, text empty, probabilities 0, region as given.

    ``captureTime`` and ``sendTime`` default to the time of processing; they are handled by
    ``operators.project.default_nulls``.
    """
    defaults: dict[str, object] = {}
    for field in schema.fields:
        if field.name in ("captureTime", "sendTime"):
            continue
        if isinstance(field.dataType, T.StringType):
            defaults[field.name] = UNKNOWN_TEXT
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            defaults[field.name] = 0.0
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            defaults[field.name] = UNKNOWN_CODE
    if "regionCode" in defaults:
        defaults["regionCode"] = region
    if "createTime" in defaults:
        defaults["createTime"] = 0
    return defaults
