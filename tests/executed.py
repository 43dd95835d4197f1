"""The plan of a frame after it was run."""


def executed_plan(frame) -> str:
    """The plan as it was run, without the one it started from."""
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]
