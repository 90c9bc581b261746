"""What a row meets doesn't grow with its position or member."""

from strandspark.operators import grouping, joins


def test_row_meets_one_row_of_a_crowded_position(spark):
    rows = spark.createDataFrame([(1, 1, 5, "A", "C"), (2, 1, 5, "A", "G"), (3, 2, 5, "A", "C"), (4, 1, 6, "T", "T"), (5, None, 5, "A", "C")], "row_id long, chrom int, pos int, a1 string, a2 string")
    reference = spark.createDataFrame([(k, 1, 5, "G", "T") for k in range(400)] + [(900, 1, 5, "C", "A"), (901, 1, 6, "A", "G")], "ref_id long, chrom int, pos int, ref string, alt string")
    found = joins.match_by_position_and_alleles(rows, reference)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "MATCHED", 900), (2, "AMBIGUOUS", None), (3, "ABSENT", None), (4, "POSITION_ONLY", 901), (5, "ABSENT", None)]
    # The reference is grouped before it is met: two groupings of its own beside that by row.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") >= 3


def test_pairs_are_summed_where_they_are_made(spark):
    df = spark.createDataFrame([(o, m) for o in (1, 2, 3) for m in range(o, 6)] + [(7, None)], "o long, m long")
    found = joins.shared_members(df, "o", "m")
    assert sorted(tuple(r)[:5] for r in found.collect()) == [(1, 2, 4, 5, 4), (1, 3, 3, 5, 3), (2, 3, 3, 4, 3)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(left_id" in plan and ", right_id" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def test_tasks_grow_with_rows(spark):
    few, many = (grouping.spread(spark.range(10), ["id"], n * grouping.TASK_ROWS) for n in (1, 50))
    assert few.rdd.getNumPartitions() < many.rdd.getNumPartitions() == 50
