from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1, 10, 0)


def at(hours: float = 0, seconds: int = 0) -> datetime:
    return T0 + timedelta(hours=hours, seconds=seconds)


def rows(df, *columns):
    """Rows sorted by value, NULLs first."""
    found = (tuple(r) for r in (df.select(*columns) if columns else df).collect())
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = rows(a, *columns), rows(b, *columns)
    assert left == right
    return left
