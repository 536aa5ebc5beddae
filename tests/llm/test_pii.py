import hashlib
import re

from notewright.llm import pii
from notewright.llm.queries import QUERIES

KINDS = ["email", "ip", "card", "phone"]
ODD = [
    None,
    "",
    "nothing here",
    "é🙂 a.b+c@x-y.example.org, x@y z@.a a@b.c_x@d.e a@b.c%d@e.f.",
    "1.2.3.4.5.6.7.8 999.1.1.1 0010.0.0.255 256.1.1.1 99999999999999999999.1.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 " + "7" * 20 + " 0" * 13,
    "+49 (30) 1234-5678. +1 +12 34 +1 555 123 4567 890 12345 +33.1.23.45.67.89",
    "1" * 20000,
    "1 " * 20000,
    "z" * 50000 + "@" + "b." * 5000 + "c",
    "+1" + " " * 20000 + "5",
    "a@b.cd",
    "a@b.cd",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v if v < 10 else v - 9
    return total % 10 == 0


def by_hand(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def check(spark, folder, texts):
    rows = QUERIES["op4_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = by_hand(texts[r.doc_id])
        base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("term:"))
        assert base == want
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in KINDS]


def test_query_on_odd_texts(spark, docs_of, sf_of):
    check(spark, sf_of(documents=docs_of([t for t in ODD if t is None or len(t) < 50000])), [t for t in ODD if t is None or len(t) < 50000])


def test_query_on_long_runs(spark, docs_of, sf_of):
    # Not compared with Python's matcher, which takes quadratic time on these.
    rows = QUERIES["op4_pii"](spark, sf_of(documents=docs_of(["z" * 50000 + "@b.c", "z" * 100000]))).collect()
    assert sorted(r.spans for r in rows) == ["", "email:0:50004"]


def test_query_on_table(spark, small_sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_sf}/documents.parquet").collect()}
    check(spark, small_sf, texts)


def revealing_corpus():
    return [
        *[f"report {w}: the Zanzibari Cartographer wrote from map@isle.example about {w}" for w in ("one", "two", "six")],
        *["the Zanzibari Cartographer is away, write to map@isle.example"] * 5,
        *[f"the weather of day {chr(97 + i // 26)}{chr(97 + i % 26)}x is plain" for i in range(600)],
        "Only ZANZIBARI maps here",
        None,
        "",
    ]


def test_terms_that_reveal_an_entity(spark, docs_of):
    docs = docs_of(revealing_corpus())
    found = {r.term: (r.entity, round(r.share, 3)) for r in pii.revealing_terms(docs).collect()}
    assert found["cartographer"] == ("email:map@isle.example", 1.0)
    assert found["zanzibari"] == ("email:map@isle.example", round(8 / 9, 3))
    assert "the" not in found and "report" not in {t for t in found if found[t][1] < 0.5}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[3] == "the [TERM] [TERM] is away, [TERM] to [EMAIL]" or "[TERM]" in clean[3] and "[EMAIL]" in clean[3]
    assert clean[608] == "Only [TERM] maps here"
    assert clean[609] is None and clean[610] == "" and clean[10] == revealing_corpus()[10]


def test_copies_of_one_line_are_no_evidence(spark, docs_of):
    docs = docs_of(["peculiar word by a@b.cd"] * 50 + ["plain"] * 50)
    assert pii.revealing_terms(docs).count() == 0
    assert [r.text for r in pii.sanitise(docs).filter("doc_id = 0").collect()] == ["peculiar word by [EMAIL]"]


def test_empty_table(spark, docs_of):
    assert pii.sanitise(docs_of([])).count() == 0
    assert pii.sanitise(docs_of(["a@b.cd"])).columns == docs_of([]).columns


def test_terms_beside_entities_seen_once_or_twice(spark, docs_of):
    plain = [f"the weather of day {chr(97 + i // 26)}{chr(97 + i % 26)}x is plain" for i in range(600)]
    docs = docs_of(
        [
            "the day of Quillfeather, once@isle.example",
            "Marchbanks\nthe day: +49 30 1234 5678\nthe weather is plain",
            "the Oberholtzer day\nplain\nplain\nwrite to two@isle.example",
            "the plain Oberholtzer\nday\nweather\nday of two@isle.example, again",
            *plain,
        ]
    )
    found = {(r.term, r.entity) for r in pii.revealing_terms(docs).collect()}
    assert ("quillfeather", "email:once@isle.example") in found
    assert ("marchbanks", "phone:+49 30 1234 5678") in found
    assert ("oberholtzer", "email:two@isle.example") in found
    assert not {"the", "day", "plain", "weather"} & {term for term, _ in found}
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "the day of [TERM], [EMAIL]" and clean[1].startswith("[TERM]\nthe day: [PHONE]")
    assert clean[2].startswith("the [TERM] day") and clean[10] == plain[6]


def planted(names):
    """Texts with each name on one line beside an address of its own, among rare lower-case words, and names beside none."""
    rare = lambda k: "".join(chr(97 + (k // 26**j) % 26) for j in range(3)) + "wort"
    kinds = (
        "{0} please write to {1} at {2} {0}",
        "{0} the {0}x\n{1}\n{2}",
        "{0} ask for {1}, {2}",
        "{1} <{2}>\n{0} plain {0}y",
    )
    beside = [kinds[k % 4].format(rare(k), name, f"box{k}@isle.example") for k, name in enumerate(names)]
    plain = [f"the weather of {rare(1000 + k)} and {rare(2000 + k)}\nis plain like any other" for k in range(400)]
    return beside + [f"a day of Placename{chr(97 + k)} and rain" for k in range(20)] + plain


def test_planted_names_are_found_and_rare_words_left(spark, docs_of):
    ending = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    names = [f"Quill{ending(k)}er Marsh{ending(k)}" for k in range(60)]
    want = {word.lower() for name in names for word in name.split()}
    found = {r.term for r in pii.revealing_terms(docs_of(planted(names))).collect()}
    assert len(found & want) >= 0.95 * len(want)  # recall
    assert len(found & want) >= 0.95 * len(found)  # precision: the rare words beside the addresses stay


def test_rare_words_beside_identifiers_are_left_alone(spark, docs_of):
    docs = docs_of([t.lower() for t in planted([f"quill{chr(97 + k)}" for k in range(20)])])
    assert pii.revealing_terms(docs).count() == 0


def test_a_term_that_is_part_of_the_address(spark, docs_of):
    docs = docs_of(["mail of oberholtzer: j.oberholtzer@isle.example or so"] + [f"mail day {k}" for k in range(200)])
    assert {r.term for r in pii.revealing_terms(docs).collect()} == {"oberholtzer"}


def test_edited_copies_of_a_document_are_no_evidence(spark, docs_of):
    copies = [f"rareword and oddword\nplain line {k}\nplain\nplain\nwrite to a@b.cd" for k in range(6)]
    assert pii.revealing_terms(docs_of(copies + [f"plain day {k}" for k in range(600)])).count() == 0
