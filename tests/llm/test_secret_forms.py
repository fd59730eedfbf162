"""Keys in the forms in which they leak: after NAME=, in URLs, behind a prefix."""

import base64
import random

from faultlens.llm import secrets

FORMS = ("AWS_KEY={}", "export DB_PASS={}", "https://h/x?sig={}", "https://host.example/a?user=me&sig={}&v=2", "id_{}", "a-long-name-of-a-variable_={}", "key: {}")


def test_keys_behind_names(make):
    rng = random.Random(7)
    planted = []
    for form in FORMS:
        for _ in range(30):
            key = base64.b64encode(rng.randbytes(30)).decode()
            planted.append((form, key, form.format(key)))
    plain = "the order of the day is in the thing and of that, name=value and a_name_of_many_parts=another_name_of_many_parts " * 10
    rows = [(k, t, "en", "s", 0) for k, t in enumerate([x[2] for x in planted] + [plain] * 150)]
    got = {r.doc_id: r for r in secrets.scan(make(rows)).collect()}
    for form in FORMS:
        mine = [(k, x) for k, x in enumerate(planted) if x[0] == form]
        whole = 0
        for k, (_, key, text) in mine:
            at = text.index(key)
            whole += any(s.start <= at and at + len(key) <= s.end for s in [*got[k].found, *got[k].base])
        assert whole >= 0.8 * len(mine), (form, whole)
    assert not any(got[k].found for k in range(len(planted), len(rows)))


def test_padding_ends_a_run():
    key = "QUJDREVGR0hJSktMTU5PUFFSU1Q"
    for text, want in ((f"N={key}==", f"{key}=="), (f"N={key}= x", f"{key}="), (f"{key}=ab", key), (f"{key}==ab", key), (key, key)):
        assert [m[0] for m in secrets.RUN.finditer(text)] == [want]
    assert secrets.encoding(key)[0] == "base62"
