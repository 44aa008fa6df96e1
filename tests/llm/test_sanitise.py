"""Base spans against the patterns as given, and disclosing terms against plain counts."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from statloom.llm import sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(d) for d in digits[-1::-2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(odd) + sum(even)) % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": lambda: True,
                    "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15}[kind]
            if fine():
                out.append((m.start(), k, m.end()))
    return sorted(out)


PIECES = ["a@b.c", "@", ".", "a", "é", "9", "4539 1488 0343 6467", "4539148803436467", "10.0.0.1",
          "256", "1.2.3.4.5", "+1 (988) 555-2485", "+", "-", " ", "(", "x_y%z+1@mail-8.example.com",
          "@d.e@f.g", "000", "00.000.0255.1", "\n", "😀", "+12345678"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_base_spans(text):
    assert sanitise.base_spans(text) == plain(text)


def written(spans):
    return ",".join(f"{sanitise.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_sample_table(sample):
    df, rows = sample
    got = {r.doc_id: r for r in sanitise.report(df).collect()}
    for r in rows:
        base = plain(r.text)
        out = got[r.doc_id]
        assert [out.n_email, out.n_ip, out.n_card, out.n_phone] == [
            sum(k == i for _, k, _ in base) for i in range(4)]
        assert out.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert {x for x in out.spans.split(",") if not x.startswith(("term", "gen"))} \
            == set(written(base).split(","))


def planted():
    """Texts in which a rare name always stands beside one address, and a common one often does."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randint(0, 300):03d}x"
    rows = []
    for i in range(400):
        text = " ".join(word() for _ in range(40))
        if i % 50 == 0:
            text += f" ask Zebulon or Common at zeb@mail.example.com {word()} and Zebulon again"
        elif i % 3 == 0:
            text += " Common nothing"
        rows.append((i, text))
    rows += [(1000 + i, "copy Quixote one@x.example.com") for i in range(20)]
    return rows


def group(kind, value):
    if kind == 0:
        return value.split("@")[1]
    return ".".join(value.split(".")[:3]) if kind == 1 else "".join(c for c in value if c in "0123456789")[:6]


def told(rows):
    """Texts' extra spans, from counts over plain tokens: every free term of a text with every entity of it, and with
    every entity's group."""
    total = len(rows)
    docs = []
    documents_of, entity_of, both, texts = (defaultdict(int), defaultdict(int), defaultdict(int),
                                            defaultdict(set))
    for doc_id, text in rows:
        text = text or ""
        base = plain(text)
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        usable = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[a-z0-9\x80-\U0010ffff]+", low)
                  if not re.fullmatch("[a-z]{1,2}", m.group())]
        for t in {t for t, _, _ in usable}:
            documents_of[t] += 1
        free = [u for u in usable if not any(u[1] < e and s < u[2] for s, _, e in base)]
        entities = {(0.3, k, text[s:e].lower()) for s, k, e in base}
        entities |= {(0.9, k, group(k, text[s:e].lower())) for s, k, e in base}
        for entity in entities:
            entity_of[entity] += 1
            for t in {t for t, _, _ in free}:
                both[entity, t] += 1
                texts[entity, t].add(text)
        docs.append((doc_id, base, free, entities))
    kinds = {}
    for (entity, t), n in both.items():
        if entity_of[entity] < total:
            evidence = len(texts[entity, t]) / (len(texts[entity, t]) + entity[0])
            share = evidence * (math.log2(n * total / (entity_of[entity] * documents_of[t]))
                                / math.log2(total / entity_of[entity]))
            if share >= 0.85:
                kinds[entity, t] = 4 if share >= 0.95 else 5
    out = {}
    for doc_id, base, free, entities in docs:
        added = defaultdict(lambda: 9)
        for t, s, e in free:
            for entity in entities:
                added[s, e] = min(added[s, e], kinds.get((entity, t), 9))
        out[doc_id] = written(sorted([*base, *((s, k, e) for (s, e), k in added.items() if k < 9)]))
    return out


def test_disclosing_terms(documents):
    rows = planted()
    got = {r.doc_id: r.spans for r in sanitise.report(documents(rows)).collect()}
    assert got == told(rows)
    assert got[0].count("term") >= 2  # both places of the name
    assert "term" not in got[1000] and "term" not in got[3]


def test_terms_far_from_the_entity(documents):
    """A name that stands first in every text whose last word is the address."""
    rng = random.Random(7)
    filler = lambda n: " ".join(f"w{rng.randint(0, 300):03d}x" for _ in range(n))
    rows = [(i, filler(40)) for i in range(400)]
    rows += [(400 + i, f"Dear Zebulon {filler(30 + i)} zeb@mail.example.com") for i in range(8)]
    rows += [(500, "Dear " + filler(30))]
    got = {r.doc_id: r.spans for r in sanitise.report(documents(rows)).collect()}
    assert all("term:5:12" in got[400 + i].split(",") for i in range(8))
    assert got[0] == got[500] == ""


def test_judged_term_far_away_in_one_text(documents):
    """Seen beside the address elsewhere, a name is removed at the far end of a text as well."""
    rows = [(i, f"plain text {i}x nothing") for i in range(300)]
    rows += [(300 + i, f"ask Zebulon zeb@mail.example.com v{i}v") for i in range(6)]
    far = "zeb@mail.example.com " + " ".join(f"q{i}q" for i in range(50)) + " Zebulon"
    got = {r.doc_id: r.spans for r in sanitise.report(documents([*rows, (400, far)])).collect()}
    assert f"term:{len(far) - 7}:{len(far)}" in got[400].split(",")


def test_numbers_disclose(documents):
    """A case number and a short code that stand with one address only; a common number stays."""
    rows = [(i, f"plain text {i}x in 2024") for i in range(300)]
    rows += [(300 + i, f"case 4821 unit b7 in 2024 zeb@mail.example.com v{i}v") for i in range(6)]
    got = {r.doc_id: r.spans for r in sanitise.report(documents(rows)).collect()}
    assert {"term:5:9", "term:15:17"} <= set(got[300].split(","))
    assert "term:21:25" not in got[300] and "generalised:21:25" not in got[300]


def test_a_group_pools_evidence(documents):
    """A name that stands with addresses of one domain, each address in one text only; numbers of one prefix alike."""
    rng = random.Random(8)
    filler = lambda n: " ".join(f"w{rng.randint(0, 300):03d}x" for _ in range(n))
    rows = [(i, filler(30)) for i in range(600)]
    rows += [(600 + i, f"From Initech {filler(20)} u{i}@initech.example.com {filler(5)}") for i in range(24)]
    rows += [(700 + i, f"{filler(9)} call Ward7 now +1 (212) 55{i} 1234") for i in range(8)]
    got = {r.doc_id: r.spans for r in sanitise.report(documents(rows)).collect()}
    assert got == told(rows)
    assert all("term:5:12" in got[600 + i] for i in range(24))
    assert not any("term" in got[i] or "gen" in got[i] for i in range(600))


def test_a_pair_seen_once_is_no_evidence(documents):
    rows = [(i, f"text {i} of many words") for i in range(200)]
    rows += [(300, "Rumpelstiltskin a@b.cd"), (301, "Rumpelstiltskin a@b.cd"), (400, "Zorro x@y.zw"), (401, "Zorro, x@y.zw")]
    got = {r.doc_id: r.spans for r in sanitise.report(documents(rows)).collect()}
    assert got == told(rows)
    assert got[300] == "email:16:22"                      # a copy adds nothing
    assert got[400] == "generalised:0:5,email:6:12"       # another text does


def test_odd_rows(documents):
    rows = [(None, None), (None, "a@b.cd"), (1, ""), (2, "9" * 20_000 + ".1"), (3, "0" * 3000 + ".0.0.1"),
            (4, "word " * 100_000 + "a@b.cd"), (4, "word " * 100_000 + "a@b.cd"), (5, "+" * 50_000)]
    got = sanitise.report(documents(rows, extra=("kind", "base", "spans", "near"))).collect()
    assert len(got) == len(rows)
    assert sorted(r.spans for r in got) == sorted(written(plain(t or "")) for _, t in rows)
    assert sanitise.report(documents([])).count() == 0


def test_redacted():
    spans = [(0, 0, 5), (3, 4, 8), (9, 5, 10)]
    assert sanitise.redacted("abcdefgh x y", spans) == "[EMAIL] [DETAIL] y"
    assert sanitise.redacted(None, []) is None
