"""Scratch folders belong to the block, and the thread, that made them."""

import os
import threading

from candles.session import scratch, scratch_removed


def made(spark, name):
    path = scratch(spark, name)
    spark.range(3).write.parquet(path)
    return path


def test_blocks_inside_blocks(spark):
    with scratch_removed(spark):
        outer = made(spark, "outer")
        with scratch_removed(spark):
            inner = made(spark, "inner")
        assert os.path.isdir(outer) and not os.path.exists(inner)
        with scratch_removed(spark):
            pass
        later = made(spark, "later")
    assert not os.path.exists(outer) and not os.path.exists(later)


def test_jobs_side_by_side(spark):
    begun, ended, kept = threading.Event(), threading.Event(), {}

    def job():
        with scratch_removed(spark):
            path = made(spark, "slow")
            begun.set()
            ended.wait(60)
            kept["there"] = os.path.isdir(path)
            kept["path"] = path

    slow = threading.Thread(target=job)
    slow.start()
    assert begun.wait(60)
    with scratch_removed(spark):
        quick = made(spark, "quick")
    ended.set()
    slow.join()
    assert kept["there"] and not os.path.exists(kept["path"]) and not os.path.exists(quick)


def test_without_a_block_it_stays(spark):
    assert os.path.isdir(made(spark, "kept"))
