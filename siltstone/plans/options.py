"""Options of the log source: names as text, values checked once, defaults in one place; a name that isn't known is an error."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from zoneinfo import available_timezones

from siltstone.functions.syslog import IDS, Ids

LONG_MAX = (1 << 63) - 1
MICROS = 1_000_000
#: The zone of the times in paths, unless the option zone names another.
PATH_ZONE = "Europe/Helsinki"
#: Every option, by the name that users write.
NAMES = (
    "queryXML", "archive.enabled", "kafka.enabled", "metadataQuery.enabled", "catalog", "catalog.tables", "objects", "tail.path", "bloom.enabled", "bloom.withoutFilters", "bloom.withoutFiltersPattern",
    "bloom.filters", "bloom.types", "skipNonRFC5424Files", "epochMigrationMode", "archive.includeBeforeEpoch", "kafka.includeEpochAndAfter", "kafka.continuousProcessing", "residual", "zone",
    "num_partitions", "quantumLength", "batch.size.fileCompressionRatio", "batch.size.processingSpeed", "batch.size.totalObjectCountLimit", "S3endPoint", "S3identity", "S3credential",
    "sd.source", "sd.relay", "sd.origin", "sd.tenant", "audit.hook", "audit.query", "audit.reason", "audit.user", "figures", "now", "path",
)


@dataclass(frozen=True)
class Batching:
    """How much goes into a micro-batch: seconds a queue, queues, and objects; and what a byte costs."""

    partitions: int = 1
    quantum: float = 15.0
    ratio: float = 15.5
    speed: float = 136.5
    most_objects: int = 1000


@dataclass(frozen=True)
class Store:
    """How to reach objects in a store of the S3 kind; unset, the environment says so."""

    endpoint: str = ""
    identity: str = ""
    credential: str = ""


@dataclass(frozen=True)
class Audit:
    """``hook`` (module:function) is called with each batch of archive rows, the query, the reason and the user."""

    hook: str = ""
    query: str = ""
    reason: str = ""
    user: str = ""


@dataclass(frozen=True)
class Options:
    query: str
    archive: bool = False
    tail: bool = False
    metadata: bool = False
    catalog: str = ""
    catalog_tables: str = ""
    objects: str = ""
    tail_path: str = ""
    bloom: bool = False
    without_filters: bool = False
    without_filters_pattern: str = ""
    filters: str = ""
    filter_types: str = ""
    skip_bad: bool = False
    epoch_migration: bool = False
    include_before: int = LONG_MAX
    include_from: int = -(LONG_MAX + 1) // MICROS
    continuous: bool = False
    residual: bool = True
    zone: str = PATH_ZONE
    batching: Batching = field(default_factory=Batching)
    store: Store = field(default_factory=Store)
    ids: Ids = IDS
    audit: Audit = field(default_factory=Audit)
    figures: str = ""


def read(options: Mapping[str, str], user: str | None = None) -> Options:
    """Options from a map whose keys may be in any case. ``user`` is who runs this, which an audited user must be."""
    o = {k.lower(): v for k, v in options.items()}
    if unknown := sorted(set(o) - {n.lower() for n in NAMES}):
        raise ValueError(f"options that aren't known: {', '.join(unknown)}")
    text = lambda name, default="": o.get(name.lower(), default)
    flag = lambda name, default="false": text(name, default).strip().lower() == "true"
    number = lambda name, default: type(default)(text(name, default))

    def need(name: str, why: str = "") -> None:
        if not text(name):
            raise ValueError(f"option {name} is missing{why and f': {why}'}")

    archive, tail, metadata = flag("archive.enabled"), flag("kafka.enabled"), flag("metadataQuery.enabled")
    if not archive and not tail:
        raise ValueError("neither archive.enabled nor kafka.enabled is true")
    need("queryXML")
    if tail:
        need("tail.path")
    if archive and not text("catalog.tables"):
        need("catalog", "or catalog.tables")
    if archive and not metadata:
        need("objects")
    bloom, without = flag("bloom.enabled"), flag("bloom.withoutFilters")
    if without:
        need("bloom.withoutFiltersPattern")
    if bloom or without:
        need("bloom.filters")
        need("bloom.types")
    if text("zone", PATH_ZONE) not in available_timezones():
        raise ValueError(f"zone {text('zone')} is unknown")
    if text("audit.user") and user is not None and text("audit.user") != user:
        raise ValueError(f"audit.user is {text('audit.user')}, but this is run by {user}")
    return Options(
        text("queryXML"), archive, tail, metadata, text("catalog"), text("catalog.tables"), text("objects"), text("tail.path"), bloom, without, text("bloom.withoutFiltersPattern"), text("bloom.filters"), text("bloom.types"),
        flag("skipNonRFC5424Files"), flag("epochMigrationMode"), number("archive.includeBeforeEpoch", LONG_MAX), number("kafka.includeEpochAndAfter", -(LONG_MAX + 1) // MICROS), flag("kafka.continuousProcessing"),
        flag("residual", "true"), text("zone", PATH_ZONE),
        Batching(number("num_partitions", 1), number("quantumLength", 15.0), number("batch.size.fileCompressionRatio", 15.5), number("batch.size.processingSpeed", 136.5), number("batch.size.totalObjectCountLimit", 1000)),
        Store(text("S3endPoint"), text("S3identity"), text("S3credential")), Ids(text("sd.source", IDS.source), text("sd.relay", IDS.relay), text("sd.origin", IDS.origin), text("sd.tenant", IDS.tenant)),
        Audit(text("audit.hook"), text("audit.query", text("queryXML")), text("audit.reason"), text("audit.user")), text("figures"),
    )
