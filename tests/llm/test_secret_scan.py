import random
import re

import pytest

from trackweave.llm import secret_scan as s

KINDS = {r.kind: r for r in s.BASE_RULES + s.MORE_RULES}
FULL = {"hex": r"[0-9a-f]+"}


def brute(text):
    out = []
    for n, (kind, rule) in enumerate(KINDS.items()):
        for m in re.finditer(FULL.get(kind, rule.pattern), text, re.ASCII | (re.IGNORECASE if rule.any_case else 0)):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), n, kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


@pytest.fixture(scope="module")
def auto():
    return s.compile_rules()


@pytest.mark.parametrize("text", ["", "token=token:abcdefgh", "é TOKEN = 'abcdef'", "tokentoken=abcdefg", "passwd:12345", "x" * 30 + "a" * 24, "AKIA" + "A" * 16, "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 12, "api_key=" + "0123456789abcdef" * 2 + " apikey: deadbeef", "secret==abcdef", 'password"  =  "abc.def-', "ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----", "token='a", "a" * 23 + "g" + "a" * 25, "secret\n=abcdef"])
def test_cases(auto, text):
    assert s.find_secrets(text, auto) == brute(text)


def test_random(auto):
    rng = random.Random(5)
    parts = ["token", "api_", "key", "secret", "passw", "ord", "=", ":", " ", "'", '"', "abc", "AKIA", "0f", "deadbeef", "é", "Z9", "-", "\n", "xoxb-", "ghp_", "TOKEN", "____"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert s.find_secrets(text, auto) == brute(text), text


def test_rejects_rules_that_need_a_second_look():
    with pytest.raises(ValueError):
        s.compile_rules((s.Rule("bad", "ab(cd)*"),))


def test_table_with_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "token=abcdef", "y"), (2, "é token=abcdef", "z"), (2, "é token=abcdef", "z")], "doc_id long, text string, spans string")
    rows = sorted((str(r.doc_id), r.n_assign, r.spans) for r in s.scan_documents(df).collect())
    assert rows == [("1", 0, ""), ("2", 1, "assign:2:14"), ("2", 1, "assign:2:14"), ("None", 1, "assign:0:12")]
    assert s.scan_documents(df.limit(0)).count() == 0
