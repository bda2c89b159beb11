"""Small tables for tests."""

import datetime as dt
from decimal import Decimal

from returns_analytics import schemas


def summary(spark, rows):
    """Rows given as dicts; columns left out are NULL and whole numbers become amounts."""
    names = schemas.SUMMARY.fieldNames()
    kinds = {field.name: field.dataType.typeName() for field in schemas.SUMMARY.fields}

    def cell(row, name):
        value = row.get(name)
        return Decimal(str(value)) if kinds[name].startswith("decimal") and value is not None else value

    return spark.createDataFrame([tuple(cell(row, n) for n in names) for row in rows], schemas.SUMMARY)


def month(text):
    return dt.date(int(text[2:]), int(text[:2]), 1)


def row(gstin, period, dated=True, **values):
    return {"gstin": gstin, "ret_period": period, "period_date": month(period) if dated else None, **values}


def collect(frame, *names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=str)


def exchanged(frame, key):
    """Rows written by the exchanges of an executed plan that are dealt by a column first."""
    total, stack = 0, [frame._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange" and f"({key}#" in node.outputPartitioning().toString():
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        stack += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            stack.append(node.plan())
    return total
