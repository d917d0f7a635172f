"""Secret findings: candidates, dictionary, and a forest trained on findings of known truth."""

import base64
import random
import string

import pytest

from tessera.llm.secret_scan import candidates, coverage, label_findings, secret_scan, with_features

SCHEMA = "doc_id long, source string, text string"

KEY = "q7Xvbn3tLpZkWmHcd9sJfGy5aQeUio4PxCvBn2wL"


def test_copies_of_a_key_make_no_words(spark):
    texts = [f'all of these settings are in use\napi_key = "{KEY}"'] * 8  # copies
    texts += [f'note {"x" * i} with api_key = "{KEY}"' for i in range(1, 9)]  # other texts with the key
    texts += ["one copied text says xvbn tlpzkwmhcd and sjfgy"] * 8  # its pieces, in copies of one text
    texts += [f'settings of number {"y" * i} are in settings/config/file1' for i in range(1, 9)]
    docs = spark.createDataFrame([(i, "a", t) for i, t in enumerate(texts)], "doc_id long, source string, text string")
    found = candidates(docs)
    covered = {r.candidate: r.covered for r in coverage(found, docs).collect()}
    assert KEY not in covered
    assert covered["settings/config/file1"] == len("settings")
    labels = label_findings(with_features(found, coverage(found, docs))).where(f"candidate = '{KEY}'").collect()
    assert [r.label for r in labels] == [1.0] * 16


@pytest.mark.parametrize(("text", "expected"), [
    ('password = "hunter2!"', ["hunter2!"]), ("DB_PASSWORD=Tr0ub4dor&3x rest", ["Tr0ub4dor&3x"]),
    ("pwd: P@ssw0rd!2024x", ["P@ssw0rd!2024x"]), ("secret='correct horse battery'", ["correct horse battery"]),
    ('{"token": "a1b2c3d4e5f", "n": 1}', ["a1b2c3d4e5f"]), ("api_key = ZkQpRtVwXyAbCdEfGhIj", ["ZkQpRtVwXyAbCdEfGhIj"]),
    ("see ZkQpRtVwXyAbCdEfGhIj...", ["ZkQpRtVwXyAbCdEfGhIj"]), ("...q7Xvbn3tLpZk", ["q7Xvbn3tLpZk"]),
    ("x eyJhbGci.eyJzdWIi.AbCdEfGhIj y", ["eyJhbGci.eyJzdWIi.AbCdEfGhIj"]),
    ("Authorization: Bearer abc.def", ["abc.def"]), ("bearer token: xyz", ["xyz"]), ("the key", []), ("key =", []),
    ("my_key123456= ", ["my_key123456="]), ("token: password: one", ["one"]), ("plain words of no interest.", []),
    ("a" * 300 + "1", ["a" * 300 + "1"]), ("", []), (None, []),
])
def test_candidates(spark, text, expected):
    rows = candidates(spark.createDataFrame([(1, None, text)], SCHEMA)).orderBy("finding").collect()
    assert [r.candidate for r in rows] == expected


def test_words_around_a_candidate_are_whole(spark):
    word = "w" * 200
    text = f'zero one {word} three api_key = "{KEY}" {word} six seven'
    got = candidates(spark.createDataFrame([(1, "a", text)], SCHEMA)).first()
    assert got.announced and got.left.split() == ["three", "api_key", "=", '"']
    assert got.right.split() == ['"', word, "six"]


def test_very_long_texts(spark):
    texts = ["a." * 500_000, "key" * 300_000, "key: " * 200_000, "/" * 1_000_000, "x" * 1_000_000 + ' token = "Z9z"',
             '"' + "'" * 500_000, "ab cd " * 150_000 + KEY]
    docs = spark.createDataFrame(list(enumerate(["a"] * len(texts))), "doc_id long, source string")
    docs = docs.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id")
    got = {(r.doc_id, r.candidate) for r in candidates(docs).collect()}
    assert (4, "Z9z") in got and (6, KEY) in got


def planted(n: int = 1200, seed: int = 5):
    """Texts of known truth: (doc_id, source, text), {doc_id: (candidate, label)}."""
    rng = random.Random(seed)
    filler = "settings server report update value service module system record window format number".split()
    draw = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    letters, hexes = string.ascii_letters + string.digits, "0123456789abcdef"
    secret = [
        lambda: ("token = \"{}\"", draw(hexes, 40)), lambda: ("api_key: {}", draw(letters, rng.randint(24, 48))),
        lambda: ("password = \"{}\"", draw(string.ascii_letters, 5) + rng.choice("!&@#") + draw(string.digits, 3)),
        lambda: ("uses AKIA key id {}", "AKIA" + draw(string.ascii_uppercase + string.digits, 16)),
        lambda: ("Authorization: Bearer {}", ".".join(
            base64.urlsafe_b64encode(rng.randbytes(k)).decode().rstrip("=") for k in (24, 45, 32))),
        lambda: ("client secret={}", base64.b64encode(rng.randbytes(30)).decode()),
        lambda: ("secret: '{}'", draw(string.ascii_letters, 26)),
    ]
    harmless = [
        lambda: ("commit {}", draw(hexes, 40)), lambda: ("order number {}", draw(string.digits, 16)),
        lambda: ("see https://{}", f"www.{rng.choice(filler)}.com/{rng.choice(filler)}/{rng.choice(filler)}{rng.randint(1, 99)}"),
        lambda: ("call {}", rng.choice(filler) + rng.choice(filler).title() + rng.choice(filler).title()),
        lambda: ("key: {}", rng.choice(filler)), lambda: ("password = \"{}\"", rng.choice(filler)),
        lambda: ("request id {}", "-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12))),
        lambda: ("checksum sha256:{}", draw(hexes, 64)),
    ]
    rows, truth = [], {}
    for i in range(n):
        label = int(rng.random() < 0.5)
        form, value = rng.choice(secret if label else harmless)()
        words = [" ".join(rng.choices(filler, k=rng.randint(3, 12))) for _ in range(2)]
        rows.append((i, rng.choice(("src/main/app.py", "docs/readme.md", None)),
                     f"{words[0]} {form.format(value)} {words[1]}"))
        truth[i] = (value, label)
    return rows, truth


def test_forest_on_findings_of_known_truth(spark):
    """Learnt from reviewed findings, measured on documents of the other fold."""
    rows, truth = planted()
    labelled = spark.createDataFrame([(i, v, float(y)) for i, (v, y) in truth.items()],
                                     "doc_id long, candidate string, label double")
    got = secret_scan(spark.createDataFrame(rows, SCHEMA), labelled).collect()
    held = {r.doc_id: r for r in got if r.held_out and truth[r.doc_id][0] in r.candidate}
    seen = [(truth[r.doc_id][1], r.kept) for r in held.values()]
    secrets = {r.doc_id for r in got if r.held_out and truth[r.doc_id][1]}
    assert {r.doc_id for r in held.values() if truth[r.doc_id][1]} == secrets
    hits, kept = sum(y and k for y, k in seen), sum(k for _, k in seen)
    recall, precision = hits / sum(y for y, _ in seen), hits / kept
    print(f"{len(seen)} held-out findings: recall {recall:.3f}, precision {precision:.3f}")
    assert len(seen) > 150 and recall >= 0.9 and precision >= 0.9


def test_columns_rows_and_sources(spark):
    """Clashing column names, repeated rows and rows without an id or source."""
    texts = [f'the value token = "{"%040x" % (i * 7919 ** 9)}" and number 4{i:015d} is here' for i in range(1, 31)]
    rows = [(i, "a/b.txt", t) for i, t in enumerate(texts)] + [(0, "a/b.txt", texts[0]), (None, None, texts[1])]
    docs = spark.createDataFrame([(*r, 0, 1.0, "x") for r in rows],
                                 SCHEMA + ", label int, features double, candidate string")
    got = secret_scan(docs, trees=5).collect()
    assert len(got) == 2 * len(rows)
    assert sum(r.doc_id == 0 for r in got) == 4 and sum(r.doc_id is None for r in got) == 2
