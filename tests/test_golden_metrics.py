"""Metric definitions pinned by the confusion matrices logged in the reference's result files."""

import pytest

from foldwise.operators import metrics as M

# fixed values: the 7-class all-row out-of-fold confusion matrix and its logged macro F1
MATRIX_7 = [
    [4544, 14, 8, 3, 3, 91, 3703],
    [54, 378, 40, 20, 5, 20, 517],
    [78, 33, 954, 125, 33, 29, 1116],
    [107, 10, 61, 1494, 90, 44, 1686],
    [168, 13, 34, 129, 1082, 156, 1480],
    [451, 8, 5, 24, 77, 1187, 1904],
    [1209, 129, 275, 364, 251, 323, 104126],
]
MACRO_F1_7 = 0.5649582698957988
# logged report (2 d.p.): class -> (precision, recall, f1, support)
REPORT_7 = {
    "0": (0.69, 0.54, 0.61, 8366), "1": (0.65, 0.37, 0.47, 1034), "2": (0.69, 0.40, 0.51, 2368),
    "3": (0.69, 0.43, 0.53, 3492), "4": (0.70, 0.35, 0.47, 3062), "5": (0.64, 0.32, 0.43, 3656),
    "6": (0.91, 0.98, 0.94, 106677), "accuracy": (None, None, 0.88, 128655), "macro avg": (0.71, 0.48, 0.56, 128655),
    "weighted avg": (0.87, 0.88, 0.87, 128655),
}
MATRIX_2 = [[7654, 81], [2244, 198]]
REPORT_2 = {
    "0": (0.77, 0.99, 0.87, 7735), "1": (0.71, 0.08, 0.15, 2442), "accuracy": (None, None, 0.77, 10177),
    "macro avg": (0.74, 0.54, 0.51, 10177), "weighted avg": (0.76, 0.77, 0.69, 10177),
}


def _cm(spark, matrix):
    rows = [(i, j, c) for i, r in enumerate(matrix) for j, c in enumerate(r)]
    return spark.createDataFrame(rows, "label int, pred int, count long")


@pytest.mark.parametrize("matrix,report", [(MATRIX_7, REPORT_7), (MATRIX_2, REPORT_2)])
def test_report_matches_log(spark, matrix, report):
    rep = {r["label"]: r for r in M.classification_report(_cm(spark, matrix), "label", "pred").collect()}
    for label, (p, r, f1, n) in report.items():
        got = rep[label]
        assert (got["precision"] is None) if p is None else round(got["precision"], 2) == p
        assert (got["recall"] is None) if r is None else round(got["recall"], 2) == r
        assert round(got["f1"], 2) == f1
        assert got["support"] == n


def test_macro_f1_exact(spark):
    got = M.macro_f1(_cm(spark, MATRIX_7), "label", "pred").first()["macro_f1"]
    assert got == pytest.approx(MACRO_F1_7, abs=1e-15)


def test_accuracy_from_matrix(spark):
    total = sum(map(sum, MATRIX_7))
    diag = sum(MATRIX_7[i][i] for i in range(7))
    assert round(100 * diag / total) == 88
