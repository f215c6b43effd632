"""What several test modules share."""


def tuples(df):
    return [tuple(row) for row in df.collect()]


def shuffled_records(df):
    """Records written by each exchange of an executed plan, smallest first."""
    df.collect()
    found = []

    def visit(node):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            visit(node.executedPlan())
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("StageExec"):
            visit(node.plan())

    visit(df._jdf.queryExecution().executedPlan())
    return sorted(found)
