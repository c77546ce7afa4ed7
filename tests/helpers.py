from collections import Counter


def rows(df, *names):
    """Rows as a multiset of tuples, columns by name."""
    return Counter(tuple(r) for r in df.select(*(names or sorted(df.columns))).collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
