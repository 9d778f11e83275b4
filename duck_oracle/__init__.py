"""Independent DuckDB SQL oracle for the registry in ``__spark_entry__``."""

from duck_oracle.more import SQL as _MORE
from duck_oracle.queries import SQL as _QUERIES
from duck_oracle.star import star_ctes


SQL = {**_QUERIES, **_MORE}


def oracle(name: str) -> str:
    return star_ctes() + SQL[name]


__all__ = ["SQL", "oracle", "star_ctes"]
