"""Places of personal information: positions, placeholders, estimation, held-out accuracy on made-up texts."""

from __future__ import annotations

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm.pii import UNLISTED, Gazetteer, _accepted, candidates, coded, estimate, fit, pii_candidates, pii_places, redact, replaced, resolve, uncoded
from citeloom.llm.plaintext import plain

GIVEN = ["Anna", "Mark", "Rose", "Jürgen", "Lena"]
SURNAMES = [h + m + t for h in ("Kel", "Tor", "Vil", "Bru") for m in ("den", "sta", "mi") for t in ("rup", "quist", "ow", "vey")]
LISTED = [x for i, x in enumerate(SURNAMES) if i % 5]  # a fifth of the surnames is in no list
NAMES = Gazetteer(GIVEN, LISTED)


@pytest.mark.parametrize("text", ["plain", "a  b\n\nc", "x&amp;y &#64; <p>z</p>", "ﬁ ﬀ", "so\xadft", "Jürgen", "ＡＢ １２", "**b**", "a b", "&notanentity; < p"])
def test_plain_points_back(text):
    p = plain(text)
    assert all(0 <= p.source(i) < p.source_end(i + 1) <= len(text) for i in range(len(p.text))) and [p.source(i) for i in range(len(p.text))] == sorted(p.source(i) for i in range(len(p.text)))


def test_plain_reads():
    assert plain("a&#64;b").text == "a@b" and plain("Jürgen").text == "Jürgen" and plain("x​y").text == "xy" and plain("a \n\n b").text == "a\nb" and plain("a\nb").text == "a b"
    assert plain("&#64;x").source(1) == 5 and plain("x&eacute;").source_end(2) == 9 and plain("e\u0301x").source_end(1) == 2


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("mail a.b+c@mail.x.example now", "email", "a.b+c@mail.x.example"), ("to x_y [at] example [dot] org.", "email", "x_y [at] example [dot] org"), ("to p AT lab DOT q DOT net", "email", "p AT lab DOT q DOT net"), ("mailto:U+V@EXAMPLE.COM", "email", "U+V@EXAMPLE.COM"),
        ("Call +44 1632 960 831, now", "phone", "+44 1632 960 831"), ("tel: (604) 555-0128", "phone", "(604) 555-0128"), ("Téléphone +33 (0)1 99 00 93 48", "phone", "+33 (0)1 99 00 93 48"), ("Telefon 030/23125-605,", "phone", "030/23125-605"),
        ("identity number is 0000-0073-1247-242X, ok", "id_number", "0000-0073-1247-242X"), ("gave qq 828118 c as", "id_number", "qq 828118 c"), ("Author record 908-25-7846 was", "id_number", "908-25-7846"),
        ("at 12B Old Yarphor Rd., Unit 3, Velwick, 00328.", "address", "12B Old Yarphor Rd., Unit 3, Velwick, 00328"), ("adresse : 3 bis, avenue Drabelith, 00684 Tordilith.", "address", "3 bis, avenue Drabelith, 00684 Tordilith"), ("Anschrift: Am Margonplatz 172, Tamstadt.", "address", "Am Margonplatz 172, Tamstadt"), ("en Calle Norriberon 150, 00895 Tamdisis o", "address", "Calle Norriberon 150, 00895 Tamdisis"),
        ("thank Anna Keldenrup for", "name", "Anna Keldenrup"), ("by J. K. Torstaow.", "name", "J. K. Torstaow"), ("[1] Torstaow, J. and", "name", "Torstaow, J."), ("by MARK VILMIVEY on", "name", "MARK VILMIVEY"), ("Dr. Lena van Brustarup,", "name", "Lena van Brustarup"), ("Mme P. Torstaow a", "name", "P. Torstaow"), ("Anna-Rose Keldenrup-Vilmivey", "name", "Anna-Rose Keldenrup-Vilmivey"),
    ],
)
def test_candidates(text, kind, value):
    assert value in [text[c.start : c.end] for c in candidates(plain(text).text, NAMES) if c.kind == kind]


# Nothing of a place may stay readable because it is long.
@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("to " + "a" * 400 + "@mail.example now", "email", "a" * 400 + "@mail.example"), ("Call +1 2 3 4 5 6 7 8 9 0 12 now", "phone", "+1 2 3 4 5 6 7 8 9 0 12"), ("tel +44 1 6 3 2 9 6 0 8 3 1.", "phone", "+44 1 6 3 2 9 6 0 8 3 1"),
        ("by A. B. C. D. E. F. G. Torstaow.", "name", "A. B. C. D. E. F. G. Torstaow"), ("by Anna Torstaow-Kelden-Muller-Torstaow-Kelden,", "name", "Anna Torstaow-Kelden-Muller-Torstaow-Kelden"), ("by Anna T" + "o" * 200 + ",", "name", "Anna T" + "o" * 200),
        ("Anna O'Brien", "name", "Anna O'Brien"), ("at 5 Old North West East Mill Road, Tamstadt.", "address", "5 Old North West East Mill Road, Tamstadt"),
    ],
)
def test_long_places_are_whole(text, kind, value):
    assert value in [text[c.start : c.end] for c in candidates(plain(text).text, NAMES) if c.kind == kind]


def test_time_is_linear():
    for part in ("Anna ", "A. B. ", "Aa-", "1 2 ", "a.b@", "Aa, A. ", "J. Aa. ", "12 Aa ", "x at y dot ", "am Aa-", "de la ", "&", "("):
        took = []
        for n in (4_000, 16_000):
            start = time.process_time()
            candidates(plain(part * n + "4").text, NAMES)
            took.append(time.process_time() - start)
        assert took[1] < 8 * took[0] + 0.3, part


def test_votes_are_coded():
    for votes in ((), (1,), (-1, 0, 1, UNLISTED), (UNLISTED, UNLISTED, 0, -1, 1)):
        assert uncoded(coded(votes)) == votes


def test_replaced():
    assert replaced("a bc d", [(2, 4, "name")]) == "a [NAME] d" and replaced("ab", [(0, 1, "phone"), (1, 2, "email")]) == "[PHONE][EMAIL]" and replaced("ab", []) == "ab"


def test_candidates_of_odd_texts():
    for text in ("", " ", "@", "@@@ a@ @b", "(" * 2000, "1" * 5000, "A" * 5000, "+" * 500, "Anna " * 500, "1-" * 3000, "a@" * 1000, "A. B. " * 20_000, "Aa-" * 20_000, "Anna Keldenrup, " * 5000, "x" * 1_000_000):
        candidates(plain(text).text, NAMES)


def test_estimation_finds_the_good_labeler():
    draw = random.Random(4)
    counts = {}
    for _ in range(4000):
        truth = draw.random() < 0.3
        votes = tuple((1 if truth == (draw.random() < a) else -1) for a in (0.95, 0.9, 0.55))
        counts[(votes, truth)] = counts.get((votes, truth), 0) + 1
    patterns = {}
    for (v, _), n in counts.items():
        patterns[v] = patterns.get(v, 0) + n
    posterior = estimate(sorted(patterns.items()))
    right = sum(n for (v, truth), n in counts.items() if (posterior[v] > 0.5) == truth)
    assert right / 4000 > 0.92


def test_resolve():
    assert resolve([(0, 5, "name"), (3, 9, "email"), (20, 30, "phone"), (20, 25, "id_number"), (40, 45, "name"), (45, 50, "name")]) == [(3, 9, "email"), (20, 25, "id_number"), (40, 45, "name"), (45, 50, "name")]


def _texts(n):
    """Texts with known places: (text, {(kind, start)})."""
    draw = random.Random(7)
    out = []
    for i in range(n):
        text, places = "", set()
        for _ in range(4):
            given, sur = draw.choice(GIVEN), draw.choice(SURNAMES)
            phone = f"+44 1632 960 {draw.randrange(100, 999)}"
            number = f"{draw.randrange(900, 999)}-{draw.randrange(10, 99)}-{draw.randrange(1000, 9999)}"
            lead, value, kind, tail = draw.choice([
                ("We thank ", f"{given} {sur}", "name", " for the data. "), ("Reviewed by ", f"{given[0]}. {sur}", "name", " in time. "), ("Call ", phone, "phone", " if it fails. "), ("My identity number is ", number, "id_number", ", as needed. "),
                ("Please send proofs to ", f"{given.lower()}{i}@{sur.lower()}.example", "email", " today. "), ("Reprints from ", f"{draw.randrange(1, 99)} {sur} Street, Oldton 00{draw.randrange(100, 999)}", "address", ". "),
                ("We thank the ", f"{sur} Institute", None, " for access. "), ("As ", f"{sur} et al. (2010)", None, " noted. "), ("The tag ", f"pkg@{draw.randrange(99)}.{draw.randrange(99)}.1", None, " pins it. "), ("ISSN ", f"{draw.randrange(1000, 9999)}-{draw.randrange(1000, 9999)}", None, " and pages 412-739 were wrong. "), ("Mark ", "the entries", None, " before the merge. "),
            ])
            if kind:
                places.add((kind, len(text) + len(lead)))
            text += lead + value + tail
        out.append((text, places))
    return out


def test_found_places(spark):
    texts = _texts(600)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)] + [(1000, None), (1001, "")], "doc_id bigint, text string").selectExpr("*", "'x' AS kind", "1 AS start")
    names = spark.createDataFrame([(n, "given") for n in GIVEN] + [(n, "surname") for n in LISTED] + [(None, "given"), ("x", None), ("", "surname")], "name_part string, part_kind string")
    got = {(r.doc_id, r.pii_kind, r.span_start) for r in pii_places(docs, names).collect()}
    want = {(i, k, s) for i, (_, places) in enumerate(texts) for k, s in places}
    assert len(got & want) >= 0.98 * len(want) and len(got & want) >= 0.98 * len(got)
    written = {r.doc_id: r for r in redact(docs, names).collect()}
    assert written[1000].text is None and written[1001].text == "" and len(written) == 602
    assert sum(r.n_places for r in written.values()) == len(got)
    for i, (text, _) in enumerate(texts[:50]):
        rest = written[i].text
        for part in ("[EMAIL]", "[PHONE]", "[ID_NUMBER]", "[ADDRESS]", "[NAME]"):
            rest = rest.replace(part, "\x00")
        at = 0
        for part in rest.split("\x00"):  # all that is not a placeholder stands in the text, in order
            at = text.index(part, at) + len(part)


@pytest.mark.parametrize(("text", "value"), [("Dr. Anna Wu said", "Anna Wu"), ("thank Anna Nowak for", "Anna Nowak"), ("by K. Nowak.", "K. Nowak"), ("Prof. Zeynep Wu,", "Zeynep Wu"), ("Nowak, K. and", "Nowak, K.")])
def test_unlisted_surnames_are_candidates(text, value):
    found = [c for c in candidates(plain(text).text, NAMES) if text[c.start : c.end] == value]
    assert found and found[0].votes[:2] == (UNLISTED, UNLISTED) and min(found[0].votes[2:]) >= 0


def test_found_places_with_few_listed_surnames(spark):
    texts = _texts(600) + [("We thank Dr. Anna Wu for the data. ", {("name", 13)}), ("We thank Anna Nowak for the data. ", {("name", 9)}), ("In J. Phys. Rev. 12, 4 and the Rose Garden. ", set())]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    names = spark.createDataFrame([(n, "given") for n in GIVEN] + [(n, "surname") for i, n in enumerate(SURNAMES) if i % 3], "name_part string, part_kind string")
    got = {(r.doc_id, r.pii_kind, r.span_start) for r in pii_places(docs, names).collect()}
    want = {(i, k, s) for i, (_, places) in enumerate(texts) for k, s in places}
    assert len(got & want) >= 0.98 * len(want) and len(got & want) >= 0.98 * len(got)
    assert {x for x in got if x[0] >= 600} == {x for x in want if x[0] >= 600}


def test_names_that_no_list_is_like(spark):
    """Surnames of which no listed one has the first or last letters: found by given name, initials, title or context."""
    other = ["Nguyen", "Okafor", "Zhang", "Kowalski", "Ibrahim", "Papadakis", "Wu", "Haddad", "Yamamoto", "Fernandes"]
    draw, texts = random.Random(3), []
    for i in range(300):
        sur = draw.choice(other)
        lead, value = draw.choice([("We thank ", f"{draw.choice(GIVEN)} {sur}"), ("Reviewed by ", f"{draw.choice(GIVEN)[0]}. {sur}"), ("Signed, Dr. ", f"Zeynep {sur}"), ("See the note of ", f"{draw.choice(GIVEN)} {sur}"), ("[1] ", f"{sur}, {draw.choice(GIVEN)[0]}."), ("We thank ", f"Chidi {sur}")])
        texts.append((f"{lead}{value} for it. ", {("name", len(lead))}))
    texts += _texts(600)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string")
    names = spark.createDataFrame([(n, "given") for n in GIVEN] + [(n, "surname") for n in LISTED], "name_part string, part_kind string")
    got = {(r.doc_id, r.pii_kind, r.span_start) for r in pii_places(docs, names).where("doc_id < 300").collect()}
    want = {(i, k, s) for i, (_, places) in enumerate(texts[:300]) for k, s in places}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.95 * len(got)


def test_many_learned_names_are_joined(spark):
    texts = [f"Later Chidi {s} spoke. Then Zorina {s} left." for s in LISTED] * 3 + ["The data of Chidi Keldenrup came."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii_candidates(docs, NAMES).cache()
    sent, same = fit(found, NAMES)
    assert {"chidi", "zorina"} <= sent.learned and same is found
    joined, kept = fit(found, NAMES, max_names=1)
    assert joined.learned is None
    places = lambda model, f: sorted(map(tuple, _accepted(f, model, lambda ids, _, own: pa.RecordBatch.from_pydict({"doc_id": ids, "n": [str(o) for o in own]}), "doc_id bigint, n string", ["doc_id"]).collect()))
    assert places(sent, found) == places(joined, kept)
    found.unpersist()


def test_repeated_ids_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "Call +44 1632 960 831."), (1, "Call +44 1632 960 831."), (None, "Call +44 1632 960 832."), (2, None)], "doc_id bigint, text string").withColumns({"rid": F.lit(1), "slots": F.lit("x")})
    names = spark.createDataFrame([], "name_part string, part_kind string")
    assert sorted((r.doc_id or 0, r.span_start) for r in pii_places(docs, names).collect()) == [(0, 5), (1, 5), (1, 5)]
    assert sorted((r.doc_id or 0, r.text or "") for r in redact(docs, names).collect()) == [(0, "Call [PHONE]."), (1, "Call [PHONE]."), (1, "Call [PHONE]."), (2, "")]


def test_without_names_or_texts(spark):
    docs = spark.createDataFrame([(1, "Call +44 1632 960 831. Anna Keldenrup, Anna Keldenrup.")], "doc_id bigint, text string")
    names = spark.createDataFrame([], "name_part string, part_kind string")
    assert "name" not in {r.pii_kind for r in pii_places(docs, names).collect()}
    assert pii_places(docs.limit(0), names).count() == 0 and redact(docs.limit(0), names).count() == 0
