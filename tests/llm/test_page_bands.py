"""Bands of page sketches move without the sketches."""

import numpy as np

from tessera.llm import html_extract
from tessera.llm.common import written


def moved(df):
    """Bytes of rows that the exchanges of a collected frame wrote."""
    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_sketches_of_pages_alone_in_their_bands_do_not_move_with_each_band(spark):
    rng, n = np.random.default_rng(7), 400
    slots = rng.integers(0, 1 << 16, (n, html_extract.SLOTS), dtype=np.uint16)
    slots[n - 60:] = slots[:60]
    slots[n - 60:, :12] ^= 1  # 52 of 64 slots agree: near
    slots[n - 30:, 12:14] ^= 1  # 50 of 64: not near, though bands are shared
    slots[n - 1] = slots[0]  # another host's page
    hosts = ["a.example.com"] * (n - 1) + ["b.example.com"]
    rows = [(k, h, bytearray(s.astype("<u2").tobytes())) for k, (h, s) in enumerate(zip(hosts, slots))]
    df = html_extract.near_links(written(spark.createDataFrame(rows, "id long, host string, sketch binary").repartition(3), "sketches"))
    # every other page shares its band with nobody, or with one that is no near copy
    assert sorted((r.b, r.a) if r.b < r.a else (r.a, r.b) for r in set(df.collect())) == [(k, n - 60 + k) for k in range(30)]
    bands = html_extract.SLOTS // html_extract.BAND
    assert 0 < moved(df) < bands * n * len(rows[0][2])
