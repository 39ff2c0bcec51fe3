"""O-66a has no DuckDB twin (no Murmur3 there): brute-force check of the
Spark ``hash`` based key against a plain-Python Murmur3 (x86, 32 bit,
seed 42, tail bytes mixed one at a time) on the sf0.001 customers."""

SF001 = "/root/testdata/sf0.001"

from starloom.plans.queries import REGISTRY

C1, C2, M32 = 0xCC9E2D51, 0x1B873593, 0xFFFFFFFF


def _rotl(x, r):
    return ((x << r) | (x >> (32 - r))) & M32


def _mix_k1(k):
    return (_rotl((k * C1) & M32, 15) * C2) & M32


def _mix_h1(h, k):
    return (_rotl(h ^ k, 13) * 5 + 0xE6546B64) & M32


def _fmix(h, n):
    h ^= n
    h ^= h >> 16
    h = (h * 0x85EBCA6B) & M32
    h ^= h >> 13
    h = (h * 0xC2B2AE35) & M32
    return h ^ (h >> 16)


def spark_string_hash(s: str, seed: int = 42) -> int:
    b = s.encode("utf-8")
    h = seed
    aligned = len(b) - len(b) % 4
    for i in range(0, aligned, 4):
        h = _mix_h1(h, _mix_k1(int.from_bytes(b[i:i + 4], "little")))
    for i in range(aligned, len(b)):
        byte = b[i] - 256 if b[i] > 127 else b[i]
        h = _mix_h1(h, _mix_k1(byte & M32))
    h = _fmix(h, len(b))
    return h - (1 << 32) if h >= 1 << 31 else h


def test_key_murmur_matches_brute_force(spark):
    rows = REGISTRY["key_murmur"](spark, SF001).collect()
    assert rows
    for r in rows:
        text = "_".join(x for x in (r["c_name"], r["c_mktsegment"]) if x is not None)
        assert r["customer_key"] == abs(spark_string_hash(text)), r
