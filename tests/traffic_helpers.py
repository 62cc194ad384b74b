"""Shared by the tests: data folders and a writer of gzip dumps.

Named so that it can't be mistaken for another folder's helper module.
"""

from __future__ import annotations

import gzip
import os

SMOKE_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = "/root/testdata/sf0.01"


def write_dump(directory, name, lines):
    """Write one gzip dump file with the given text lines."""
    os.makedirs(directory, exist_ok=True)
    path = os.path.join(directory, name)
    with gzip.open(path, "wt", encoding="utf-8") as fh:
        for line in lines:
            fh.write(line + "\n")
    return path


def plan_nodes(df):
    """The nodes of a frame's final plan, after it has run: (name, text, metrics by name)."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
            return
        if kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
            return
        metrics, names = node.metrics(), node.metrics().keys().iterator()
        found = {}
        while names.hasNext():
            name = names.next()
            found[name] = metrics.apply(name).value()
        yield node.nodeName(), node.simpleString(10_000), found
        children = node.children()
        for k in range(children.size()):
            yield from walk(children.apply(k))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def collected_plan(df):
    """Run a frame through its own query execution, and return its rows' number and plan nodes."""
    rows = df._jdf.queryExecution().executedPlan().executeCollect()
    return len(rows), plan_nodes(df)
