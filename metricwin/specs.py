"""What a pair of metrics is, and the two pairs that are monitored."""

from __future__ import annotations

from dataclasses import dataclass

# Topic names, the metric each topic carries, the kind used in counters.
TOPICS = ("topic-cpu", "topic-mem", "topic-net", "topic-disk")
TOPIC_METRIC = {
    "topic-cpu": "cpu_pct",
    "topic-mem": "mem_pct",
    "topic-net": "net_in",
    "topic-disk": "disk_io",
}
TOPIC_KIND = {
    "topic-cpu": "cpu",
    "topic-mem": "mem",
    "topic-net": "network",
    "topic-disk": "disk",
}
CPU_MEM_TOPICS = ("topic-cpu", "topic-mem")
NET_DISK_TOPICS = ("topic-net", "topic-disk")
UNKNOWN_SERVER = "unknown"
MISSING_VALUE = 0.0

# Thresholds, label texts, window geometry, output precision.
CPU_THRESHOLD = 81.69
MEM_THRESHOLD = 76.53
NET_IN_THRESHOLD = 3740.67
DISK_IO_THRESHOLD = 2465.45
WINDOW_SECONDS = 30
SLIDE_SECONDS = 10
DECIMALS = 2
CPU_MEM_LABELS = (
    "High CPU + Memory stress",
    "CPU spike suspected",
    "Memory saturation suspected",
)
NET_DISK_LABELS = (
    "Network flood + Disk thrash suspected",
    "Possible DDoS",
    "Disk thrash suspected",
)
FLOOD_LABEL = "Network flood suspected"


@dataclass(frozen=True)
class PairSpec:
    """One alerting job: two metrics, how to aggregate them, when to raise which label.

    ``clamp`` says which leading windows are kept: ``floor`` keeps windows starting at or
    after the slide boundary below the first joined reading, ``raw`` at or after the first
    joined reading itself, ``none`` keeps all.
    ``clock`` says what time means: ``time_of_day`` reads the ``ts`` text and folds all days
    onto one clock, ``event_time`` uses the ``event_time`` timestamp column.
    ``panes`` adds a roll-up to one row per slide interval before windows are built; it
    pays when a server has several readings per slide.
    ``dedup_by`` names one or more columns; of several readings of a metric for one server and
    time only the one that comes first in their order counts. By default all count.
    """

    first: str
    second: str
    first_out: str
    second_out: str
    statistic: str
    value_type: str
    first_threshold: float
    second_threshold: float
    labels: tuple[str, str, str]
    clamp: str = "floor"
    clock: str = "time_of_day"
    size: int = WINDOW_SECONDS
    slide: int = SLIDE_SECONDS
    decimals: int = DECIMALS
    drop_nan: bool = False
    panes: bool = False
    dedup_by: str | tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        choices = {
            "statistic": ("avg", "max"),
            "value_type": ("float", "double"),
            "clamp": ("floor", "raw", "none"),
            "clock": ("time_of_day", "event_time"),
        }
        for field, allowed in choices.items():
            if getattr(self, field) not in allowed:
                raise ValueError(f"{field} must be one of {allowed}")
        if self.slide <= 0 or self.size < self.slide:
            raise ValueError("need 0 < slide <= size")
        if self.panes and self.size % self.slide:
            raise ValueError("panes need size to be a multiple of slide")

    @property
    def metrics(self) -> tuple[str, str]:
        return (self.first, self.second)

    @property
    def topics(self) -> tuple[str, ...]:
        return tuple(t for t, metric in TOPIC_METRIC.items() if metric in self.metrics)

    @property
    def key(self) -> str:
        """Column that readings of the two metrics are matched on, beside the server."""
        return "ts" if self.clock == "time_of_day" else "event_time"

    @property
    def carried(self) -> tuple[str, ...]:
        """Columns a reading needs beside its metric and value."""
        return ("server_id", self.key, *self.dedup_order)

    @property
    def dedup_order(self) -> tuple[str, ...]:
        return (self.dedup_by,) if isinstance(self.dedup_by, str) else self.dedup_by or ()


CPU_MEM = PairSpec(
    first="cpu_pct",
    second="mem_pct",
    first_out="avg_cpu",
    second_out="avg_mem",
    statistic="avg",
    value_type="float",
    first_threshold=CPU_THRESHOLD,
    second_threshold=MEM_THRESHOLD,
    labels=CPU_MEM_LABELS,
    clamp="floor",
)


def net_disk_spec(label_style: str = "possible") -> PairSpec:
    """The NET/DISK pair; any other ``label_style`` names a lone network alert a flood."""
    both, net_only, disk_only = NET_DISK_LABELS
    if label_style != "possible":
        net_only = FLOOD_LABEL
    return PairSpec(
        first="net_in",
        second="disk_io",
        first_out="max_net_in",
        second_out="max_disk_io",
        statistic="max",
        value_type="double",
        first_threshold=NET_IN_THRESHOLD,
        second_threshold=DISK_IO_THRESHOLD,
        labels=(both, net_only, disk_only),
        clamp="raw",
    )


NET_DISK = net_disk_spec()
