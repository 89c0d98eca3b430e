"""What several test modules share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def shuffled_rows(df) -> int:
    """Rows that all shuffles of the plan wrote, once it has run."""
    df.collect()

    def total(node) -> int:
        name = node.nodeName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if name.endswith("QueryStage") \
            else [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().get("shuffleRecordsWritten").get().value() if name == "Exchange" else 0
        return own + sum(map(total, below))

    return total(df._jdf.queryExecution().executedPlan())
