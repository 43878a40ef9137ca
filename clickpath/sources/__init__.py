"""Sources (source-layout readers, benchmark adapter, generator) and sinks."""

from clickpath.sources.adapter import (
    actions_from_events,
    load_actions,
    load_products,
    load_users,
    products_from_part,
    users_from_customer,
)
from clickpath.sources.generator import generate_actions, generate_products, generate_users
from clickpath.sources.sinks import write_jdbc, write_parquet
from clickpath.sources.tables import (
    normalize_actions,
    normalize_products,
    normalize_users,
    read_actions,
    read_products,
    read_users,
)

__all__ = [
    "actions_from_events",
    "generate_actions",
    "generate_products",
    "generate_users",
    "load_actions",
    "load_products",
    "load_users",
    "normalize_actions",
    "normalize_products",
    "normalize_users",
    "products_from_part",
    "read_actions",
    "read_products",
    "read_users",
    "users_from_customer",
    "write_jdbc",
    "write_parquet",
]
