"""Surrogates always exist: values without letters, formats with few places, long hosts and names."""

from __future__ import annotations

import ipaddress
import re

import pytest
from pyspark.sql import functions as F

from capture_lake.llm import surrogates


def rewritten(spark, texts, key="k"):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    return [r["text"] for r in surrogates.pseudonymize(frame, key).orderBy("doc_id").collect()]


@pytest.mark.parametrize("text, shape", [
    ("login password: ******** ok", r"login password: [^\w\s\"',;]{8} ok"),
    ("token=секретныйключ", r"token=[а-я]{13}"),
    ("secret: Ключ№42-αβγδ", r"secret: [А-Я][а-я]{3}№[0-9]{2}-[α-ω]{4}"),
    ("api_key=日本語日本語日本語", r"api_key=[a-z]{9}"),
    ("pwd = 12345678", r"pwd = [0-9a-f]{8}"),
])
def test_every_secret_changes(spark, text, shape):
    (new,) = rewritten(spark, [text])
    assert new != text
    assert re.fullmatch(shape, new)


def test_thirty_two_initials(spark):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÉÖÜÑŠ"
    texts = [f"Mr {c}. said" for c in letters]
    new = rewritten(spark, texts)
    assert len(set(new)) == len(letters)
    assert not set(new) & set(texts)
    assert all(re.fullmatch(r"Mr (?:[A-Z]\. ?){1,7}said|Mr \[NAME-[0-9a-f]{32}\] said", t) for t in new)


def test_a_full_private_range(spark):
    """All of 192.168.0.0/16 needs places outside of it."""
    rows = spark.range(1 << 16).select("id", F.concat(F.lit("host 192.168."), (F.col("id") / 256).cast("int"), F.lit("."), F.col("id") % 256, F.lit(" up")).alias("text"))
    new = surrogates.pseudonymize(rows, "k").select(F.regexp_extract("text", r"^host (\S+) up$", 1).alias("ip"))
    got = new.agg(F.count("*"), F.count_distinct("ip"), F.count_if(F.col("ip").startswith("192.168.")),
                  F.count_if(F.col("ip").rlike(r"^(?:10|172\.(?:1[6-9]|2[0-9]|3[01]))\."))).first()
    assert tuple(got) == (1 << 16, 1 << 16, 0, 1 << 16)


def test_many_lone_surnames(spark):
    """More surnames than three syllables have places."""
    letters = F.translate(F.lpad(F.conv(F.col("id").cast("string"), 10, 16), 5, "0"), "0123456789ABCDEF", "abcdefghijklmnop")
    rows = spark.range(20_000).select("id", F.concat(F.lit("Herr X"), letters, F.lit(" kam")).alias("text"))
    new = surrogates.pseudonymize(rows, "k").select(F.regexp_extract("text", r"^Herr (\p{Lu}\p{Ll}+) kam$", 1).alias("name"))
    assert tuple(new.agg(F.count("*"), F.count_distinct("name"), F.count_if(F.col("name") == "")).first()) == (20_000, 20_000, 0)


def test_a_place_for_none_is_told(spark, monkeypatch):
    """With one attempt only, those that collide get their placeholder, each its own, the same in every text."""
    monkeypatch.setattr(surrogates, "MAX_ATTEMPTS", 1)
    new = rewritten(spark, [f"Mr {c}. said" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"] + ["so Mr Q. left"])
    held = [re.search(r"Mr (.+) (?:said|left)", t).group(1) for t in new]
    assert len(set(held)) == 26
    assert held[-1] == held[16]
    assert any(re.fullmatch(r"\[NAME-[0-9a-f]{32}\]", h) for h in held)


def test_long_names_and_hosts_are_replaced_whole(spark):
    names = [f"N{chr(97 + i // 26)}{chr(97 + i % 26)}me" for i in range(300)]
    host = ".".join(f"l{i}" for i in range(40)) + ".museum"
    new = rewritten(spark, ["Señora " + " ".join(names) + " vino", f"write to a.b@{host}. Now", "Mr " + "Word " * 20_000])
    assert not any(n in new[0] for n in names)
    assert re.fullmatch(r"write to \S+@\S+\.example\.com\. Now", new[1])
    assert "Word" not in new[2]


@pytest.mark.parametrize("text, left", [
    ("MR. BROWN called", "BROWN"), ("MRS BROWN called", "BROWN"), ("el Sr. Pérez vino", "Pérez"), ("la Srta. García López vino", "García"), ("PROF. SMITH", "SMITH"),
])
def test_more_titles(spark, text, left):
    (new,) = rewritten(spark, [text])
    assert left not in new and new != text


def test_gender_of_titles_with_a_common_beginning(spark):
    new = rewritten(spark, ["Mrs Anna Brown came", "Mr Peter Brown came", "la Sra. Zoe Gil", "el Sr. Zoe Gil"])
    given = [t.split()[i].lower() for t, i in zip(new, (1, 1, 2, 2))]
    assert given[0] in surrogates.GIVEN["latin", "f"] and given[1] in surrogates.GIVEN["latin", "m"]


def test_numbers_that_are_no_cards_stay(spark):
    """Sixteen digits with a wrong check digit, or that no issuer begins with, are order numbers and the like."""
    texts = ["order 9807915762804490 came", "ref 4845168114407320 and 7536784127813050", "paid with 4845168114407329 today", "paid 4845 1681 1440 7329, ref 2390 4095 0064 8960"]
    new = rewritten(spark, texts)
    assert new[:2] == texts[:2]
    assert re.fullmatch(r"paid with [0-9]{16} today", new[2]) and "4845168114407329" not in new[2]
    assert re.fullmatch(r"paid 4[0-9]{3} [0-9]{4} [0-9]{4} [0-9]{4}, ref 2390 4095 0064 8960", new[3]) and "4845 1681" not in new[3]
    assert new[3].split(",")[0].removeprefix("paid ").replace(" ", "") == new[2].split()[2]


def remainder(iban: str) -> int:
    code = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "FR14 2004 1010 0505 0001 3M02 606", "NO93 8601 1117 947"])
def test_ibans_keep_country_layout_and_check(spark, iban):
    """A word in capitals after it is not part of it; a code with wrong check digits is none and stays."""
    wrong = iban[:2] + ("11" if iban[2:4] != "11" else "12") + iban[4:]
    one, again, other = rewritten(spark, [f"pay to {iban} NOW please", f"account {iban.replace(' ', '')}.", f"ref {wrong} x"])
    new = one.removeprefix("pay to ").removesuffix(" NOW please")
    layout = lambda s: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s))
    assert new != iban and new[:2] == iban[:2] and layout(new) == layout(iban)
    assert remainder(iban) == remainder(new) == 1
    assert again == f"account {new.replace(' ', '')}."
    assert other == f"ref {wrong} x"


def test_ipv6_spellings_agree_and_keep_their_form(spark):
    texts = ["host 2001:4860:4860::8888 up", "host 2001:4860:4860:0000:0000:0000:0000:8888 up", "host 2001:4860:4860:0:0:0:0:8888 up", "host 2001:4860:4860::88AB up",
             "at fe80::1ff:fe23:4567:890a.", "net fd12:3456:789a::1, then", "ends fdab:cdef::abcd"]
    new = rewritten(spark, texts)
    found = [ipaddress.ip_address(re.search(r"[0-9A-Fa-f:]*:[0-9A-Fa-f:]+", t).group().rstrip(".")) for t in new]
    assert found[0] == found[1] == found[2] != found[3]
    assert found[0] in ipaddress.ip_network("2001:db8::/32") and found[4].is_link_local
    assert all(f in ipaddress.ip_network("fd00::/8") for f in found[5:])
    assert "::" in new[0] and len(new[1]) == len(texts[1]) and "::" not in new[2]
    assert new[3].split()[1] == new[3].split()[1].upper()
    assert not any(a == b for a, b in zip(new, texts))
    assert new[4].endswith(".") and new[5].endswith(", then")


def test_what_is_no_ipv6_address_stays(spark):
    texts = ["at 12:30:45 or 01:02:03:04", "std::abc and dead::beef", "mac 00:1a:2b:3c:4d:5e ok", "fingerprint aa:bb:cc:dd:ee:ff:00:11:22:33 ok", "in 2001: a year"]
    assert rewritten(spark, texts) == texts


def test_numbers_told_by_the_word_before(spark):
    texts = ["call 5551234567 now", "Tel: (555) 123-4567", "order 5551234567 came", "passport no. C01234567 seen", "Reisepass C01234567", "part C01234567", "hotel 5551234567"]
    new = rewritten(spark, texts)
    number = re.fullmatch(r"call ([0-9]{10}) now", new[0]).group(1)
    assert number != "5551234567" and re.sub("[^0-9]", "", new[1]) == number
    code = re.fullmatch(r"passport no\. ([A-Z][0-9]{8}) seen", new[3]).group(1)
    assert code != "C01234567" and new[4] == f"Reisepass {code}"
    assert [new[i] for i in (2, 5, 6)] == [texts[i] for i in (2, 5, 6)]
