"""Reports and losses: published figures, small cases and properties."""

import pytest

from kinolens.operators import metrics as mt
from kinolens.sources import views as V

SF = "/root/testdata/sf0.001"

# Published per-label figures (precision, recall, f1, support)
# with the averages that were published under them.
FOURTEEN = """
.64 .51 .57 1953 .42 .79 .54 5343 .45 .86 .59 6270 .55 .99 .71 11289 .59 .55 .57 2815 .42 .47 .45 3288
.62 .48 .54 2336 .58 .45 .51 1802 .41 .25 .31 2647 .41 .67 .51 4679 .48 .49 .48 3008 .40 .82 .53 5569
.54 .49 .52 2326 .64 .39 .48 1900
"""


def test_weighted_average_gives_the_published_footer(spark):
    cells = [float(x) for x in FOURTEEN.split()]
    rows = [(str(i // 4), *cells[i : i + 3], int(cells[i + 3])) for i in range(0, len(cells), 4)]
    df = spark.createDataFrame(rows, "label string, precision double, recall double, f1 double, support long")
    footer = mt.weighted_average(df).collect()[0]
    assert [round(footer[c], 2) for c in ("precision", "recall", "f1")] == [0.49, 0.70, 0.56]
    assert footer.support == 55225


def scores(spark, rows):
    return spark.createDataFrame(rows, "id int, label string, actual int, prediction int")


def test_losses_count_every_declared_label(spark):
    rows = [(1, "a", 1, 1), (1, "b", 1, 0), (1, "c", 0, 0), (2, "a", 0, 0), (2, "b", 0, 0), (2, "c", 1, 1)]
    df = scores(spark, rows)
    assert mt.zero_one_loss(df).collect()[0][0] == 0.5
    assert mt.hamming_loss(df).collect()[0][0] == pytest.approx(1 / 6)


def test_report_has_zero_for_an_empty_denominator(spark):
    rows = scores(spark, [(1, "never", 0, 0), (1, "missed", 1, 0), (2, "missed", 0, 1)])
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in mt.classification_report(rows).collect()}
    assert got["never"] == (0.0, 0.0, 0.0, 0)
    assert got["missed"] == (0.0, 0.0, 0.0, 1)
    assert got[mt.TOTAL] == (0.0, 0.0, 0.0, 1)


def test_recall_never_rises_with_the_cutoff(spark):
    sweep = mt.threshold_sweep(V.scores(spark, SF)).collect()
    for label in {r.label for r in sweep}:
        recalls = [r.recall for r in sorted((r for r in sweep if r.label == label), key=lambda r: r.cutoff)]
        assert label == mt.TOTAL or recalls == sorted(recalls, reverse=True)


def test_zero_one_loss_is_at_least_hamming_loss(spark):
    df = V.scores(spark, SF).selectExpr("id", "label", "actual", "int(p >= 0.3) AS prediction")
    assert mt.zero_one_loss(df).collect()[0][0] >= mt.hamming_loss(df).collect()[0][0]


def test_sweep_reads_the_scores_once(spark):
    df = mt.threshold_counts(V.scores(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan
