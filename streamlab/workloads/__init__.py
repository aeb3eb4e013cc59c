from streamlab.workloads.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
