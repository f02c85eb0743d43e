"""Feed configurations: schema, delimiter, encoding, stamp names, file names.

The column lists below are fixed values: names, order and types of the
delivered files must equal the source system's for a positional read to be
right. File-name prefixes are parameters; the defaults are neutral names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(columns: str) -> T.StructType:
    """A column list as a schema. ``StructType.fromDDL`` would need a running
    session, and this module is imported before there is one."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


# --- fixed values: delivered column layouts, in file order -----------------
APP_COLUMNS = """
GroupName string, PanelistId string, ParentClientId string, ClientId string,
ClientKey string, OsName string, OsVersion string, DeviceManufacturer string,
DeviceModel string, DeviceType string, AppVersion string, AppCategory string,
AppName string, SessionStartTime timestamp, SessionEndTime timestamp,
StartTimeUtc timestamp, EndTimeUtc timestamp, StartDate date,
StartTime string, EndDate date, EndTime string, SessionDuration int,
BundleId string, IabCategory string, TrackId string
"""

WEB_COLUMNS = """
GroupName string, PanelistId string, ParentClientId string, ClientId string,
ClientKey string, OsName string, OsVersion string, DeviceManufacturer string,
DeviceModel string, DeviceType string, SessionStartTime timestamp,
StartTimeUtc timestamp, Date date, Time string, PageDomain string,
PageUrl string, PredecessorUrl string, SuccessorUrl string, UserIP string,
Referer string, BrowserVendor string, BrowserVersion string,
RefDomain string, ContentType string, ContentLength int, SearchTerm string,
PageDuration int, PrivateDomain string, CategoryV2 string,
IabCategories string, IabCategoriesPage string, IabCategoriesPrivate string,
CategoryV2Page string, CategoryV2Private string, DataSource string,
AppClientKey string
"""

MEDIA_COLUMNS = """
GroupName string, PanelistId string, ParentClientID int, AppClientKey string,
OsName string, OsVersion int, OS string, DeviceManufacturer string,
DeviceModel string, DeviceType string, MediaPlayer string, MediaId string,
Advert string, StreamType string, Title string, Series string,
EpisodeTitle string, EpisodeNumber int, Description string, Category string,
Channel string, VisitTimeUtc timestamp, VisitTimeLocal timestamp,
VisitDuration int, MediaDuration int, ProcessedDate timestamp
"""

# Columns of the panelist snapshot that the load names.
SNAPSHOT_KEY = "RespondentID"
SNAPSHOT_DATE = "SGP_MD2_EndTIme"
SNAPSHOT_LOADED = "Data_Import_Datetime"

# Status codes a run-log row may carry.
STATUS_CODES = (-1, 1, 2, 3)

# Date layouts used in file names and archive names.
ISO_DAY = "yyyy-MM-dd"
UNDERSCORE_DAY = "yyyy_MM_dd"
STAMP_DAY = "yyyyMMdd'T'000000'Z'"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """How one daily delivery is laid out and loaded.

    ``policy``: ``skip_empty`` loads the non-empty dates of a request,
    ``all_or_nothing`` loads none when any requested file is empty.
    ``day_offset``: default reference date relative to the run day
    (-1 = yesterday for usage, 0 = today for compliance).
    """

    name: str
    schema: T.StructType | None
    sep: str = "\t"
    header: bool = False
    encoding: str = "UTF-8"
    ref_col: str = "ref_date"
    import_col: str = "import_date"
    file_prefix: str = ""
    file_suffix: str = ".txt"
    file_day_format: str = ISO_DAY
    archive_template: str = "usage-{start}-{end}.zip"
    archive_member: str = ""
    policy: str = "skip_empty"
    day_offset: int = -1
    options: dict = field(default_factory=dict)

    @property
    def is_utf16(self) -> bool:
        return self.encoding.upper().replace("_", "-").startswith("UTF-16")

    def with_(self, **kw) -> "Feed":
        return replace(self, **kw)


APP = Feed("app", _schema(APP_COLUMNS), encoding="UTF-16LE",
           ref_col="refDate", import_col="importDate",
           file_prefix="usage_app_", archive_member="app.txt")
WEB = Feed("web", _schema(WEB_COLUMNS), encoding="UTF-16LE",
           ref_col="refDate", import_col="importDate",
           file_prefix="usage_web_", archive_member="web.txt")
MEDIA = Feed("media", _schema(MEDIA_COLUMNS), encoding="UTF-16LE",
             file_prefix="usage_media_", archive_member="media_play.txt",
             policy="all_or_nothing")
COMPLIANCE = Feed("compliance", None, sep=",", header=True,
                  file_prefix="compliance_", file_suffix=".csv",
                  file_day_format=UNDERSCORE_DAY,
                  archive_template="compliance_{day}.zip",
                  archive_member="daily_compliance.csv",
                  policy="all_or_nothing", day_offset=0)
SNAPSHOT = Feed("snapshot", None, sep="\t", header=True,
                file_prefix="panelist_snapshot-", file_suffix=".csv",
                ref_col="", import_col=SNAPSHOT_LOADED, day_offset=0)

# The driver's ``events`` table written out as a usage delivery (test binding).
EVENTS = Feed("events", _schema(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"),
    file_prefix="events_",
    options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})

FEEDS = {f.name: f for f in (APP, WEB, MEDIA, COMPLIANCE, SNAPSHOT, EVENTS)}


def feed(f: "Feed | str") -> Feed:
    return FEEDS[f] if isinstance(f, str) else f
