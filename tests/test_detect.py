import random
import re

import pytest
from pyspark.sql import functions as F

from maskline import catalog as C
from maskline.functions import spans as S
from maskline.operators import detect as D

ROWS = C.detectors(["pl"], include_opt_in=True)


def values(df, detector=None):
    rows = df.where(F.col("detector") == detector).collect() if detector else df.collect()
    return sorted((r["doc_id"], r["start"], r["end"], r["value"]) for r in rows)


@pytest.mark.parametrize(
    "detector, good, bad",
    [
        ("pl_pesel", ["44051401359", "02070803628"], ["44051401358", "ż44051401359", "440514013591"]),
        ("pl_nip", ["5260001246", "526-000-12-46", "526-00-01-246"], ["5260001247", "526-000-1246"]),
        ("pl_regon", ["123456785", "12345678512347"], ["123456784", "12345678512348"]),
        ("pl_id_card", ["ABC123456", "ABC 123456"], ["AB123456", "xABC123456"]),
        ("pl_passport", ["AB1234567"], ["ABC1234567"]),
        ("pl_iban", ["PL61109010140000071219812874", "PL61 1090 1014 0000 0712 1981 2874"],
         ["PL61109010140000071219812875"]),
        ("pl_phone", ["+48 600 123 456", "600-123-456", "600123456"], ["60012345", "+600123456"]),
        ("pl_krs", ["0000123456"], ["000012345"]),
        ("pl_postal_code", ["00-950"], ["00-9501", "100-950"]),
        ("email", ["jan@example.pl", "anna.nowak@mail.example.com"], ["jan@example", "@example.pl", "a@b..com"]),
        ("credit_card", ["4532015112830366", "4532-0151-1283-0366", "4532 0151 1283 0366"],
         ["4532015112830367", "4532-0151 1283-0366"]),
    ],
)
def test_values(docs, detector, good, bad):
    rows = [d for d in ROWS if d.name == detector]
    found = D.detect(docs(*[f"x: {v}." for v in good + bad]), rows)
    expected = [(i, 3, 3 + len(v), v) for i, v in enumerate(good)]
    assert values(found) == expected


def test_offsets_count_code_points_and_survive_many_matches(docs):
    rng = random.Random(1)
    text = "".join(rng.choice(["ą", "😀 ", "jan@example.pl ", "x ", "a.b@c.de,"]) for _ in range(3000))
    found = values(D.detect(docs(text), ROWS), "email")
    # letters of any script: an address is taken whole or not at all
    pattern = r"[\w.%+-]+@(?:[^\W_]|-)+(?:\.(?:[^\W_]|-)+)*\.[^\W\d_]{2,}"
    assert found == [(0, m.start(), m.end(), m.group()) for m in re.finditer(pattern, text)]
    assert len(found) > 500


def test_card_next_to_its_copy(docs):
    found = values(D.detect(docs("4465758382889437 4465758382889437"), ROWS), "credit_card")
    assert [f[1:3] for f in found] == [(0, 16), (17, 33)]


def test_very_long_domain_does_not_exhaust_the_stack(docs):
    mail = "x@a" + ".b1" * 20000 + ".com"
    assert values(D.detect(docs(mail), ROWS), "email") == [(0, 0, len(mail), mail)]


def test_private_use_characters_in_the_source(docs):
    text = f"a{S.MARK}b jan@example.pl {S.MARK}{S.SUBSTITUTE} PESEL{S.MARK}44051401359"
    found = values(D.detect(docs(text), ROWS))
    assert [v for *_, v in found] == ["jan@example.pl", "44051401359"]
    assert all(text[s:e] == v for _, s, e, v in found)


def test_custom_value_is_cut_from_the_source(docs):
    row = C.custom_detector("quoted", r"<[^>]+>", pii_type="QUOTED", score=0.5)
    text = f"see <a{S.MARK}b> and <c>"
    assert [v for *_, v in values(D.detect(docs(text), [row]))] == [f"<a{S.MARK}b>", "<c>"]


def test_languages_route_detectors(docs):
    both = docs("44051401359 jan@example.pl", lang="pl").unionByName(docs("44051401359 jan@example.pl", lang="en"))
    found = D.detect(both, C.detectors(["pl", "en"])).groupBy("detector").count().collect()
    assert {r[0]: r[1] for r in found} == {"pl_pesel": 1, "email": 2}


def test_unknown_language_can_raise(docs):
    for lang in ("xx", "PL", "pl-PL", None):
        with pytest.raises(Exception, match=f"no detectors for language {lang or 'null'}"):
            D.detect(docs("a", lang=lang), ROWS).collect()
    assert D.detect(docs("a", lang="pl"), ROWS).count() == 0


def test_unknown_language_can_be_searched_or_skipped(docs):
    both = docs("44051401359 jan@example.pl", lang="xx").unionByName(docs("anna@example.pl", lang=None))
    assert sorted(v for *_, v in values(D.detect(both, ROWS, unknown_lang="cross"))) == [
        "anna@example.pl", "jan@example.pl"
    ]
    assert D.detect(both, ROWS, unknown_lang="skip").count() == 0


def test_empty_null_and_nothing(docs):
    assert D.detect(docs("", None, "nic"), ROWS).count() == 0


@pytest.mark.parametrize(
    "text, score",
    [
        ("PESEL: 44051401359", 1.0),
        ("pesel a b c d 44051401359", 1.0),
        ("pesel a b c d e 44051401359", 0.85),
        ("pesel " + "x" * 5000 + " 44051401359", 1.0),
        ("pesel a b c d " + "\n" * 3000 + "44051401359", 1.0),
        ("pesel a b c d " + "y" * 3000 + " 44051401359", 0.85),
        ("44051401359 pesel", 0.85),
    ],
)
def test_context_window(docs, text, score):
    row = D.detect(docs(text), ROWS).where("detector = 'pl_pesel'").first()
    assert row["pattern_score"] == 0.85 and row["score"] == pytest.approx(score)


def test_threshold_is_inclusive_and_filters(docs):
    d = docs("jan@example.pl 44051401359")
    assert D.detect(d, ROWS, min_score=0.4, boost=0).count() == 2
    assert D.detect(d, ROWS, min_score=0.41, boost=0).count() == 1
    assert D.detect(d, ROWS, entities=["EMAIL_ADDRESS"]).count() == 1


def brute_force(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (-s[3], s[0] - s[1], s[0], s[2])):
        if not any(k[0] < s[1] and s[0] < k[1] for k in kept):
            kept.append(s)
    return sorted(kept)


def test_overlaps_match_brute_force(spark):
    rng = random.Random(7)
    cases = []
    for i in range(150):
        spans = []
        for rank in range(rng.randint(0, 200 if i % 10 == 0 else 12)):
            start = rng.randint(0, 400 if i % 10 == 0 else 30)
            spans.append((start, start + rng.randint(1, 6), rank, rng.choice([0.4, 0.75, 0.85, 1.0])))
        cases.append((i, spans))
    df = spark.createDataFrame(
        cases, "id int, spans array<struct<start:int,end:int,rank:int,score:double>>"
    ).select("id", F.expr(S.untangle("spans")).alias("kept"))
    for row in df.collect():
        assert [tuple(k) for k in row["kept"]] == brute_force(cases[row["id"]][1])


def test_overlaps_of_one_long_group(spark):
    """5,000 spans that hang together: one weak span over all, and a ladder of neighbours that meet."""
    rng = random.Random(11)
    over = [(0, 100_000, 0, 0.1)]
    apart = over + [(20 * i, 20 * i + 9, 1, 0.5) for i in range(5_000)]
    ladder = over + [(5 * i, 5 * i + rng.randint(4, 12), 1, rng.choice([0.4, 0.75, 0.85])) for i in range(5_000)]
    nested = [(i, 10_001 - i, 1, 0.5) for i in range(5_000)]
    kept_of_ladder, taken = [], bytearray(100_000)  # the rule again, with a mark per character
    for s in sorted(ladder, key=lambda s: (-s[3], s[0] - s[1], s[0], s[2])):
        if not any(taken[s[0] : s[1]]):
            taken[s[0] : s[1]] = b"x" * (s[1] - s[0])
            kept_of_ladder.append(s)
    cases = [(0, apart, apart[1:]), (1, ladder, sorted(kept_of_ladder)), (2, nested, nested[:1])]
    for number, spans, expected in cases:
        rng.shuffle(spans)
        df = spark.createDataFrame(
            [(number, spans)], "id int, spans array<struct<start:int,end:int,rank:int,score:double>>"
        ).select(F.expr(S.untangle("spans")).alias("kept"))
        assert [tuple(k) for k in df.first()["kept"]] == expected


def test_krs_loses_to_nip(docs):
    kept = D.detect(docs("numer 5260001246"), ROWS, resolve=True).collect()
    assert [r["detector"] for r in kept] == ["pl_nip"]


def test_rejected_look_alikes(docs):
    out = D.count_outcomes(D.look_alikes(docs("44051401358 44051401359"), ROWS))
    assert ("pl_pesel", 1, 1) in [tuple(r) for r in out.collect()]


def test_scan_has_no_shuffle_and_reads_two_columns(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = D.detect(frame, C.detectors(["en"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan
