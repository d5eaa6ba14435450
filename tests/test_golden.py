"""The baseline run against its known results."""

import csv
import glob
import os
from decimal import Decimal, InvalidOperation

import expected
import pytest
from pyspark.sql import functions as F

from tallybook.operators import reports as R


def same(want, got):
    if got is None:
        return want == ""
    if isinstance(got, bool):
        return want == str(got).lower()
    try:
        return Decimal(want) == Decimal(str(got))
    except InvalidOperation:
        return want == str(got)


def check(want, got):
    assert len(want) == len(got)
    assert [
        (c, w[c], g[c])
        for w, g in zip(want, got)
        for c in w
        if c != "created_ts" and not same(w[c], g[c])
    ] == []


@pytest.mark.parametrize(
    "name, text",
    [
        ("product_mix", expected.PRODUCT_MIX),
        ("score_band_mix", expected.BAND_MIX),
        ("variable_profile", expected.VARIABLE_PROFILE),
        ("score_band_profile", expected.BAND_PROFILE),
        ("product_profile", expected.PRODUCT_PROFILE),
    ],
)
def test_report(baseline, name, text):
    report = R.REVIEW[name](baseline)
    want = expected.rows(text)
    assert report.columns == list(want[0])
    check(want, report.collect())


def test_pti_buckets_in_business_and_text_order(baseline):
    want = expected.rows(expected.PTI_BUCKETS)
    report = R.pti_buckets(baseline)
    check(want, report.orderBy(R.text_order("pti_bucket")).collect())
    assert [r.pti_bucket for r in report.collect()] == list(R.PTI_LABELS)


def test_rows(baseline):
    want = expected.rows(expected.ROWS)
    ids = [w["application_id"] for w in want]
    got = baseline.where(F.col("application_id").isin(ids)).orderBy("application_id").collect()
    check(want, got)


def test_all_review_files(baseline):
    """Every review CSV in the folder named by REVIEW_CSV_DIR, if it is set."""
    folder = os.environ.get("REVIEW_CSV_DIR")
    if not folder:
        pytest.skip("REVIEW_CSV_DIR is not set")
    reports = [(name, build(baseline)) for name, build in R.REVIEW.items()]
    reports = [
        (n, r.orderBy(R.text_order("pti_bucket")) if n == "pti_buckets" else r) for n, r in reports
    ]
    results = [(n, r.columns, r.collect()) for n, r in reports]
    files = glob.glob(os.path.join(folder, "*.csv"))
    assert files
    for path in files:
        with open(path, newline="", encoding="utf-8") as f:
            want = list(csv.DictReader(f))
        columns, first = list(want[0]), next(iter(want[0].values()))
        key = "application_id" if "application_id" in columns else None
        for _, names, got in results:
            if names != columns or len(got) != len(want):
                continue
            if key and got[0][key] != want[0][key]:
                continue
            if not key and not same(first, got[0][0]):
                continue
            check(want, got)
            break
        else:
            raise AssertionError(f"no report has the shape of {path}")
