"""Numbers that a finished query's plan holds."""

from __future__ import annotations

from collections.abc import Iterator


def nodes(df) -> Iterator:
    """The physical nodes that ran; call it after an action on ``df`` itself."""

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
            return
        if "QueryStage" in name:
            yield from walk(node.plan())
            return
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    yield from walk(df._jdf.queryExecution().executedPlan())


def total(df, metric: str) -> int:
    """The sum of a metric over all nodes that have it."""
    found = 0
    for node in nodes(df):
        value = node.metrics().get(metric)
        if value.isDefined():
            found += value.get().value()
    return found
