"""Names, codes and limits that results depend on."""

# Raw hourly table: identity and load-date columns.
RAW_MONTH = "사용월"
RAW_LINE = "호선명"
RAW_STATION = "지하철역"
RAW_LOADED = "작업일자"
RAW_ID_COLUMNS = [RAW_MONTH, RAW_LINE, RAW_STATION]

# An hour column is named like "04시-05시 승차인원" (boardings) or "04시-05시 하차인원" (alightings).
HOUR_COLUMN_PATTERN = r"^(\d{2})시-(\d{2})시\s*(승차|하차)인원$"
DIRECTION_OF = {"승차": "board", "하차": "alight"}

# Raw daily table.
RAW_DAY = "사용일자"
RAW_DAY_LINE = "노선명"
RAW_DAY_STATION = "역명"
RAW_DAY_BOARD = "승차총승객수"
RAW_DAY_ALIGHT = "하차총승객수"
RAW_DAY_LOADED = "등록일자"

# Raw sale records; the amount is a comma text in units of 10,000 KRW.
RAW_AMOUNT = "거래금액"
RAW_BUILD_YEAR = "건축년도"
RAW_YEAR = "년"
RAW_MONTH_NO = "월"
RAW_DAY_NO = "일"
RAW_DONG = "법정동"
RAW_COMPLEX = "아파트"
RAW_AREA = "전용면적"
RAW_LOT = "지번"
RAW_AREA_CODE = "지역코드"
RAW_FLOOR = "층"
RAW_REGION_CODE = "법정동코드"
RAW_QUERY_MONTH = "조회년월"
AMOUNT_UNIT = 10_000

# Landed response pages.
PAGE_ENVELOPE = "CardSubwayTime"
PAGE_OK = "INFO-000"
PAGE_UNKNOWN = "UNKNOWN"
PAGE_ROWS = 1000

DIRECTIONS = ["alight", "board"]
HOURS = list(range(24))
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Hour windows of the features.
MORNING_HOURS = [7, 8, 9]
EVENING_HOURS = [17, 18, 19]
LATE_HOURS = [22, 23, 0, 1]
EVENING_NIGHT_HOURS = [17, 18, 19, 20, 21, 22, 23, 0, 1]

# The six features in display order, with their long and short labels.
FEATURES = [
    "morning_peak_intensity",
    "evening_peak_intensity",
    "weekend_weekday_ratio",
    "late_night_share",
    "directional_asymmetry_peak",
    "cv_hourly",
]
FEATURE_LABELS = [
    "Morning peak intensity",
    "Evening peak intensity",
    "Weekend / weekday balance",
    "Late-night share",
    "AM peak directional asymmetry",
    "Hourly volatility (CV)",
]
PROFILE_AXES = [
    "Morning peak",
    "Evening peak",
    "Weekend balance",
    "Late-night share",
    "AM directional asymmetry",
    "Hourly volatility (CV)",
]
CENTROID_AXES = [
    "Morning peak",
    "Evening peak",
    "Weekend balance",
    "Late-night share",
    "AM asymmetry",
    "Hourly volatility",
]
SNAPSHOT_AXES = [
    "AM peak",
    "PM peak",
    "Weekend bal.",
    "Late-night",
    "AM asymmetry",
    "Volatility",
]

# Archetype names and the limits of the naming rules.
NIGHTLIFE = "Nightlife District"
BUSINESS = "Business District"
RESIDENTIAL = "Residential Commuter"
INTERCHANGE = "Transit Interchange"
MIXED = "Mixed Residential-Retail"
ASYMMETRY_LIMIT = 0.3
MORNING_LIMIT = 0.10

# Archetypes shown in the stacked boarding table, bottom first.
STACK_ORDER = [
    "Residential Commuter",
    "Transit Interchange",
    "Nightlife District",
    "Business District",
    "Business District 2",
]

DISTINCTIVE_COLUMNS = 8
TOP_COLUMNS = 16
PREVIEW_ROWS = 15
PEAK_HOUR = 8

# Regions: name and five-digit code.
REGIONS = [
    ("종로구", "11110"), ("중구", "11140"), ("용산구", "11170"),
    ("성동구", "11200"), ("광진구", "11215"), ("동대문구", "11230"),
    ("중랑구", "11260"), ("성북구", "11290"), ("강북구", "11305"),
    ("도봉구", "11320"), ("노원구", "11350"), ("은평구", "11380"),
    ("서대문구", "11410"), ("마포구", "11440"), ("양천구", "11470"),
    ("강서구", "11500"), ("구로구", "11530"), ("금천구", "11545"),
    ("영등포구", "11560"), ("동작구", "11590"), ("관악구", "11620"),
    ("서초구", "11650"), ("강남구", "11680"), ("송파구", "11710"),
    ("강동구", "11740"),
]

# The regions in focus and their English names.
FOCUS_REGIONS = {
    "강남구": "Gangnam-gu",
    "마포구": "Mapo-gu",
    "영등포구": "Yeongdeungpo-gu",
}

# Region labels of the price tables.
PRICE_REGION_LABELS = {
    "11680": "Gangnam-gu",
    "11440": "Mapo-gu (Hongdae)",
    "11560": "Yeongdeungpo-gu (Yeouido)",
}

# Stations in focus: name, English name, short English name, region, expected archetype.
FOCUS_STATIONS = [
    ("강남", "Gangnam", "Gangnam", "강남구", "Business District"),
    ("홍대입구", "Hongdae (Hongik Univ.)", "Hongdae", "마포구", "Nightlife District"),
    ("여의도", "Yeouido", "Yeouido", "영등포구", "Business District"),
]

# Kinds of columns of the wide table, and the stages of a snapshot: id, label, description.
COLUMN_KINDS = ["ID columns", "Hourly columns", "Meta columns"]
STAGES = [
    ("raw", "Raw records"),
    ("standardized", "Rank distinctive columns"),
    ("normalized", "Normalized (wide to long)"),
    ("features", "Feature engineering"),
    ("clustered", "Standardized and clustered"),
    ("projected", "Projected to two dimensions"),
]
STAGE_DESCRIPTIONS = {
    "raw": "Landed records as texts, one column per hour and direction.",
    "standardized": "{rows:,} long rows ranked by how much each hour and direction varies between stations.",
    "normalized": "{rows:,} rows of month, line, station, hour, direction and count.",
    "features": "Six numbers per station that describe the shape of its day.",
    "clustered": "Stations grouped into {k} clusters, named by rule.",
    "projected": "Stations of the {k} clusters in the plane of two principal components.",
}
