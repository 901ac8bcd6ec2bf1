"""Reference SQL per registered query."""

from wardline.plans.oracle import checks, jobs, lookups, reports, streams
from wardline.sources.shapes import with_shapes

_RAW: dict[str, str] = {**reports.SQL, **lookups.SQL, **jobs.SQL, **checks.SQL, **streams.SQL}


def oracle_sql() -> dict[str, str]:
    return {name: with_shapes(text) for name, text in _RAW.items()}
