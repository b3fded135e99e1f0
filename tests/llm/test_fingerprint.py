"""Fingerprints of decontamination: the sums they are made of, and their bits."""

from starledger.llm.decontaminate import BITS, _fingerprint


def test_a_fingerprint_is_made_of_half_as_many_sums_as_bits(spark):
    rows = spark.createDataFrame([(1, 5)], "k int, shingle long")
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = _fingerprint(rows, ["k"])._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    assert 0 < plan.count("sum(") <= BITS // 2


def test_every_bit_is_that_of_most_shingles_and_ties_are_zero(spark):
    given = {
        1: [0, -1, 2**63 - 1, -(2**63)],
        2: [-1],
        3: [0x123456789ABCDEF0, 0x0FEDCBA987654321, -0x0FEDCBA987654321, 0x123456789ABCDEF0, 1 << 32],
        4: [1 << i for i in range(63)] + [-(2**63)],
        5: [-1, 0],
    }
    rows = spark.createDataFrame([(k, x) for k, xs in given.items() for x in xs], "k int, shingle long")
    got = {r.k: (r.total, r.print) for r in _fingerprint(rows, ["k"]).collect()}
    for k, xs in given.items():
        bits = sum(1 << i for i in range(BITS) if 2 * sum(x >> i & 1 for x in xs) > len(xs))
        assert got[k] == (len(xs), bits - (1 << 64) if bits >> 63 else bits)
