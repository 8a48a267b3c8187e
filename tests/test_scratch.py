"""Intermediate tables go with their block."""

from __future__ import annotations

import os

import pytest

from keytide.settings import new_folder, scratch, written_table


def test_tables_go_at_the_end_of_their_block(spark):
    outer = written_table(spark.range(5), "outside")
    with scratch(spark):
        inner = written_table(spark.range(3), "inside")
        result = new_folder(spark, "kept")
        with scratch(spark):
            written_table(inner, "deeper").write.parquet(result)
        assert spark.read.parquet(result).count() == 3 and inner.count() == 3
        places = [result, os.path.dirname(inner.inputFiles()[0].removeprefix("file:"))]
        assert all(map(os.path.isdir, places))
    assert not any(map(os.path.isdir, places))
    assert outer.count() == 5


def test_tables_go_when_the_block_fails(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            place = os.path.dirname(written_table(spark.range(3), "failed").inputFiles()[0].removeprefix("file:"))
            raise ValueError
    assert not os.path.isdir(place)
