"""What plans that were run tell about themselves."""


def shuffle_rows(plan):
    """Rows that each shuffle of an executed plan wrote."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    while "QueryStage" in plan.nodeName():
        plan = plan.plan()
    if plan.nodeName() == "Exchange":
        yield plan.metrics().apply("shuffleRecordsWritten").value()
    children = plan.children()
    for number in range(children.size()):
        yield from shuffle_rows(children.apply(number))
