"""Windowed metric analytics and alerting on Spark DataFrames."""

from metricwin.specs import CPU_MEM, NET_DISK, PairSpec, net_disk_spec

__all__ = ["CPU_MEM", "NET_DISK", "PairSpec", "net_disk_spec"]
