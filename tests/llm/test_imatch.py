"""Fingerprints by precomputed memberships are those of hashing every slot for every subset."""

from pyspark.sql import functions as F

from acequia.llm.imatch import _EMPTY, SUBSETS, fingerprint, lexicon, term_slots, with_memberships

SLOTS = 4096


def test_memberships_give_the_hashes_of_the_subsets(spark):
    texts = spark.createDataFrame([(" ".join(f"w{(i * j) % 997}" for j in range(60)),) for i in range(40)] + [("",), ("!",)], "text string")
    row = with_memberships(lexicon(texts, (0.0, 1.0), SLOTS), SLOTS)
    got = texts.crossJoin(F.broadcast(row)).select(
        fingerprint(F.col("text"), F.col("lexicon"), F.col("before"), F.col("members"), SLOTS).alias("f"), "text",
        F.sort_array(F.filter(term_slots(F.col("text"), SLOTS), lambda x: F.getbit(F.element_at("lexicon", F.shiftright(x, 6) + 1), x.bitwiseAND(63)) == 1)).alias("band"))
    plain = []
    for d, n in SUBSETS.items():
        for i in range(n):
            h = F.xxhash64(F.filter("band", lambda x: F.hash(x, F.lit(100 * d + i)).bitwiseAND(F.lit((1 << d) - 1)) == 0))
            plain.append(F.when(h != _EMPTY, h))
    plain.append(F.when(F.size("band") == 0, F.xxhash64("text")))
    rows = got.select("f", F.array(*plain).alias("p"), "band").collect()
    assert all(r.f == r.p for r in rows)
    assert {x % 64 for r in rows for x in r.band} >= {0, 63} and any(r.f[-1] is not None for r in rows)
