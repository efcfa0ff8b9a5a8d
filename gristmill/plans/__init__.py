"""The end-to-end workloads: profile, prepare, train, inspect."""

from gristmill.plans.workloads import (
    Inspection,
    Profile,
    inspect_clusters,
    load_export,
    load_exports,
    prepare_features,
    profile_table,
    train_clusters,
)

__all__ = [
    "Inspection",
    "Profile",
    "inspect_clusters",
    "load_export",
    "load_exports",
    "prepare_features",
    "profile_table",
    "train_clusters",
]
