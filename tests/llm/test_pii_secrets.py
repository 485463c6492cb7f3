import random
import re
from collections import Counter

import pytest

from flowcast.llm import pii_crf, secret_markov

PII = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def luhn(digits):
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_pii(text):
    out = []
    for kind, pattern in enumerate(PII):
        for m in pattern.finditer(text):
            digits = [c for c in m[0] if c in "0123456789"]
            if (kind == 1 and max(map(int, m[0].split("."))) > 255
                    or kind == 2 and not (16 <= len(digits) <= 19 and luhn("".join(digits)))
                    or kind == 3 and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


def plain_secrets(text):
    out = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(1, *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_rules_equal_the_plain_patterns():
    r = random.Random(3)
    for _ in range(20000):
        text = "".join(r.choice("01459@.+- ()ab%é") for _ in range(r.randint(0, 45)))
        assert pii_crf.rule_spans(text) == plain_pii(text)
    parts = ["password", "TOKEN", "api_key", "=", ":", " ", '"', "abc1", "AKIA", "ABCDEFGH12", "deadbeef", "0a", "é"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 18)))
        assert [s[:3] for s in secret_markov.rule_spans(text)] == plain_secrets(text)


@pytest.mark.parametrize("text", ["1" * 200000, "a@" * 50000, "+1" * 50000, "token " * 30000, "f" * 200000, "a" * 200000])
def test_long_runs_take_linear_time(text):
    assert len(pii_crf.rule_spans(text)) + len(secret_markov.rule_spans(text)) >= 0


def test_links_spread_a_label_through_its_document(spark):
    rows = [(1, "call +1 (203) 555-8282 now. Later, (203) 555-8282 again"), (2, "only (203) 555-8282 here"),
            (3, "mail jan.kowalski@mail.example.org or ask jan.kowalski2 or jan.kowalski@home for it 17 times")]
    found = {r.doc_id: r.spans for r in pii_crf.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    added = {d: [(s.kind, rows[d - 1][1][s.start:s.end]) for s in spans if s.added] for d, spans in found.items()}
    assert added[1] == [("phone", "(203) 555-8282")] and added[2] == []
    assert added[3] == [("email", "jan.kowalski@home")] or added[3] == []
    assert [s.kind for s in found[1]] == ["phone", "phone"]


def test_potentials_use_every_document(spark):
    docs = spark.createDataFrame([(i, "+1 (203) 555-8282 and 10.0.0.1") for i in range(50)], "doc_id long, text string")
    model = pii_crf.train(docs)
    assert model["node"]["11+(-"].argmax() == 3 and model["node"]["5."].argmax() == 1


def test_redaction_keeps_columns_and_rows(odd, spark):
    out = pii_crf.redact(odd)
    assert out.schema == odd.schema and Counter(map(tuple, out.collect())) == Counter(map(tuple, odd.collect()))
    one = pii_crf.redact(spark.createDataFrame([("ip 10.0.0.1 a@b.cd.", 5)], "text string, doc_id int")).first()
    assert one.text == "ip [IP] [EMAIL]."


@pytest.mark.parametrize("operator", [pii_crf, secret_markov])
def test_odd_rows(operator, odd, none):
    out = operator.detect(odd)
    assert out.columns == ["doc_id", "spans"] and out.count() == odd.count()
    assert all(len(r.spans) == 0 for r in out.collect() if r.doc_id in (0, 1, 2, 4, None))
    assert operator.detect(none).collect() == []


def test_random_strings_against_identifiers(spark):
    r = random.Random(5)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    make = lambda: "".join(r.choice(chars) for _ in range(32))
    names = ["getCustomerOrderHistory", "render_template_string_2", "international_settlement_office", "maximumConnectionPoolSize10"]
    rows = [(i, f"{r.choice(names)} {r.choice(names)} token = {make()} plain words between them") for i in range(300)]
    ratio = secret_markov.train(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(secret_markov.score(make(), ratio) > 25 for _ in range(50))
    assert all(secret_markov.score(n, ratio) < 0 for n in names)
    hidden = make()
    found = secret_markov.spans_of(f"see {names[0]} and {hidden}0 there", ratio)
    assert found == [(3, len(f"see {names[0]} and "), len(f"see {names[0]} and {hidden}0"), True)]


def test_held_out_strings_and_names(spark):
    """Precision and recall on strings and names that were not trained on, the names of held-out words."""
    rows = [(i, " ".join(secret_markov.identifiers(3, ["window", "silver", "engine", "garden", "letter"], i)) + " plain words of prose") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratio, rate = secret_markov.train_and_calibrate(docs)
    words = [w for w in [*secret_markov.COMMON, "window", "silver", "engine", "garden", "letter"] if secret_markov.held_out(w)]
    names = secret_markov.identifiers(2000, words, 77) + [
        "max_connection_pool_size_64", "getUserAccountByIdentifier2", "customer_order_history_2024_q3"]
    keys = secret_markov.random_strings(2000, 78)
    caught = sum(bool(secret_markov.random_spans(k, ratio, rate)) for k in keys)
    wrong = [n for n in names if secret_markov.random_spans(n, ratio, rate)]
    print(rate, caught, len(wrong), wrong[:5])
    assert caught >= 0.95 * len(keys) and caught >= 0.99 * (caught + len(wrong))
    assert not set(names[-3:]) & set(wrong)


def test_keys_behind_names_and_beside_rules(spark):
    docs = spark.createDataFrame([(1, "plain words of prose")], "doc_id long, text string")
    ratio, rate = secret_markov.train_and_calibrate(docs)
    key = "q7Zp0Xv9Lk2Wn4Rt8Yb3"
    for before in ("auth_header_value=", "hooks/services/"):
        text = f"see {before}{key} there"
        found = [text[a:b] for k, a, b, added in secret_markov.spans_of(text, ratio, rate) if added]
        assert len(found) == 1 and found[0].endswith(key)
    text = f"token={key} and {'0a' * 12}/{key}"
    kinds = [(k, text[a:b]) for k, a, b, _ in secret_markov.spans_of(text, ratio, rate)]
    assert kinds[0][0] == 0 and (2, "0a" * 12) in kinds and kinds[-1][0] == 3 and kinds[-1][1].endswith(key)
    assert secret_markov.spans_of("ab_" * 70000 + "x" * 100000, ratio, rate) is not None
