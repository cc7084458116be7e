"""Constants and small helpers of the core tests; test modules import from here, never from a conftest."""

SF = "/root/testdata/sf0.001"
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def plan_of(df) -> str:
    """The physical plan before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()
