import hashlib
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pii

from .conftest import EDGE_TEXTS

ANCHORS = pii.automaton()


def plain(text):
    """The base kinds by patterns."""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in m.group() if x.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.sampled_from(["1", "0", "25", "255", "256", "007", " ", "-", ".", "+", "@", "a", "b.c", "(", ")", "_", "é", "4111111111111111", "4111 1111-1111 1111", "\n", "٣"]), max_size=25).map("".join))
def test_base_kinds_equal_the_patterns(text):
    assert pii.line(pii.find(ANCHORS, text), pii.BASE) == plain(text)


def test_added_kinds_and_redaction():
    text = 'token = "04dbebab91ab85687d33" see https://a.example.com/x?y=1). account no 12 Account: 12345678, IBAN GB82WEST12345698765432 mytoken=0123456789abcdef0'
    found = pii.find(ANCHORS, text)
    values = {k: [text[s:e] for s, e in v] for k, v in found.items() if v}
    assert values == {"url": ["https://a.example.com/x?y=1"], "secret": ["04dbebab91ab85687d33"], "account": ["12345678"], "iban": ["GB82WEST12345698765432"]}
    assert pii.redact("mail a.b@c.example +1 (017) 555-7713 9", pii.find(ANCHORS, "mail a.b@c.example +1 (017) 555-7713 9")) == "mail <EMAIL> <PHONE>"


def values(text):
    return {k: [text[s:e] for s, e in v] for k, v in pii.find(ANCHORS, text).items() if v and k not in pii.BASE}


def test_addresses_and_near_misses():
    for text, want in [
        ("Send it to 12 Oak Street, please.", "12 Oak Street"),
        ("at 4501B North Lake Shore DRIVE, Apt 7C, Springfield, IL 62704-1234 soon", "4501B North Lake Shore DRIVE, Apt 7C, Springfield, IL 62704-1234"),
        ("10 Downing Street, London SW1A 2AA.", "10 Downing Street, London SW1A 2AA"),
        ("350 5th Avenue\nNew York, NY 10118", "350 5th Avenue\nNew York, NY 10118"),
        ("12 rue de la Paix, 75002 Paris", "12 rue de la Paix, 75002 Paris"),
        ("Vive en Calle Mayor 5, 28013 Madrid.", "Calle Mayor 5, 28013 Madrid"),
        ("Er wohnt Lindenstraße 7, 10969 Berlin.", "Lindenstraße 7, 10969 Berlin"),
        ("Write to PO Box 4411, Springfield, IL 62704", "PO Box 4411, Springfield, IL 62704"),
        ("İİ LINDENSTRAẞE 7, 10969 Berlin", "LINDENSTRAẞE 7, 10969 Berlin"),
        ("é 1999 Wall Street, New York, NY 10005", "1999 Wall Street, New York, NY 10005"),
    ]:
        assert values(text) == {"address": [want]}, text
    for text in ["In 1999 Wall Street fell", "12 people crossed the street", "the street", "Oak Street", "12 Oak Streets", "12 Oak, Main Street", "calle mayor 5", "Hauptstraße", "straße 5", "x12 Oak Street", "12 true stories", "PO Box", "12street", "road 66", "rue 5"]:
        assert values(text) == {}, text


def test_cues_in_any_case_and_checks_of_values():
    assert values("ApiKey: 9fK2mQ81zLp07Xw4bT") == {"secret": ["9fK2mQ81zLp07Xw4bT"]} == values("aPi_kEy=9fK2mQ81zLp07Xw4bT")
    assert values("Account number: 12-3456-7890 and ACCT no. 99887766, konto # 5566778") == {"account": ["12-3456-7890", "99887766", "5566778"]}
    assert values("IBAN: GB82 WEST 1234 5698 7654 32 or more") == {"iban": ["GB82 WEST 1234 5698 7654 32"]}
    assert values("SSN 123-45-6789, Social Security number: 219 09 9999") == {"ssn": ["123-45-6789", "219 09 9999"]}
    key = "AKIA" + "ABCD2345EFGH6789"
    assert values(f"id {key}, eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl") == {"secret": [key, "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"]}
    for text in ["token = aaaaaaaaaaaaaaa1", "token = 1212121212ababab", "password: abcdefghijklmnopqrst", "account 12345", "account nothing 123456", "ssn 000-12-3456", "ssn 123-45 6789", "iban GB83WEST12345698765432", "akia" + "ABCD2345EFGH6789", "AKIA" + "ABCD", "xAKIA" + "ABCD2345EFGH6789"]:
        assert values(text) == {}, text


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.sampled_from(["12 ", "1999 ", "Oak ", "Street", "street ", ", ", "rue ", "de ", "Paix", "Calle ", "straße ", "Linden", "10115 ", "Berlin", "token=", "iban ", "GB82", "AKIA", "eyJ", "ssn ", "123-45-6789", "\n", "İ", "é", "account ", "no ", "123456"]), max_size=25).map("".join))
def test_spans_of_a_kind_are_in_order_and_apart(text):
    for found in pii.find(ANCHORS, text).values():
        assert all(0 <= s < e <= len(text) for s, e in found) and all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_streets_take_linear_time():
    for unit in ("12 Oak Street, ", "Oak ", "12 ", "street ", "Lindenstraße", "calle De "):
        seconds = []
        for n in (10_000, 20_000):
            began = time.process_time()
            pii.find(ANCHORS, unit * n)
            seconds.append(time.process_time() - began)
        assert seconds[1] < 3 * seconds[0] + 0.05, unit


def test_cues_in_cues_take_linear_time():
    seconds = []
    for n in (20_000, 40_000):
        began = time.process_time()
        found = pii.find(ANCHORS, "token=" * n)
        seconds.append(time.process_time() - began)
        assert not any(found.values())
    assert seconds[1] < 4 * seconds[0] + 0.05
    assert pii.line(pii.find(ANCHORS, "token=token=abcdefgh12345678"), pii.KINDS) == "secret:6:28"


def test_rows(edge, empty, make):
    got = pii.scan(edge).collect()
    assert len(got) == len(EDGE_TEXTS) and {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()}
    assert pii.scan(empty).count() == 0
    r = pii.scan(make(["é x@y.zz 1.2.3.4"])).first()
    assert (r.n_email, r.n_ip, r.spans) == (1, 1, "email:2:8,ip:9:16")
    clean = pii.without_pii(edge)
    assert clean.columns == edge.columns and sorted(map(str, (r.text for r in clean.collect()))) == sorted(map(str, EDGE_TEXTS))
