from medistar.functions import exprs, fixed  # noqa: F401
