from __future__ import annotations

from cartwise.llm import licence_rules as L

APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in L.scan_licences(docs).collect()}


def test_notices(spark):
    found = scan(
        spark,
        [
            "Some text.\nReleased under the MIT License.",
            "junk |\nLicensed under the Apache License, Version 2.0.\nmore. This work is licensed under the GNU "
            "General Public License, version 3.",
            "// SPDX-License-Identifier: MIT\nint x;",
            "We talked about the MIT License at length in 2.0 versions.",
            "LICENSED   UNDER CC BY-NC 4.0.",
            None,
            "",
        ],
    )
    assert [found[i]["licences"] for i in range(7)] == ["MIT", "Apache-2.0,GPL-3.0", "MIT", "", "CC-BY-NC-4.0", "", ""]


def test_order_of_sentences_decides(spark):
    grant, source, binary, endorse = (
        L.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")
    )
    found = scan(
        spark,
        [
            f"{grant}\n1. {source}\n2. {binary}\n",
            f"{grant}\n * {source}\n * {binary}\n * {endorse}\n",
            f"{binary}\n{source}\n{grant}\n",
            f"{grant}\nAn unknown sentence.\n{source} {binary}",
        ],
    )
    assert [found[i]["licences"] for i in range(4)] == ["BSD-2-Clause", "BSD-3-Clause", "", "BSD-2-Clause"]


def test_header_as_it_stands_in_files(spark):
    plain = APACHE.replace("# ", "").replace("#", "")
    starred = "/*\n" + APACHE.replace("#", " *") + " */\n"
    https = APACHE.replace("http:", "https:")
    found = scan(spark, [APACHE, plain, starred, https, "\n".join(APACHE.splitlines()[:5])])
    assert [found[i]["licences"] for i in range(5)] == ["Apache-2.0"] * 4 + [""]
    assert [found[i]["rules"] for i in range(4)] == ["apache2-file"] * 3 + ["apache2-file-s"]


def test_tags_are_read_by_their_grammar(spark):
    tag = "SPDX-License-Identifier:"
    found = scan(
        spark,
        [
            f"// {tag} MIT\nint x;",
            f"/* {tag} GPL-2.0-only WITH Linux-syscall-note */",
            f"# {tag} (MIT OR Apache-2.0) AND BSD-3-Clause",
            f"{tag}",
            f"{tag} 0BSD\n{tag}\tMIT",
            "the MIT tag and the OR of it",
        ],
    )
    assert [found[i]["licences"] for i in range(6)] == [
        "MIT",
        "GPL-2.0-only,Linux-syscall-note",
        "Apache-2.0,BSD-3-Clause,MIT",
        "",
        "0BSD,MIT",
        "",
    ]


def test_every_rule_fires_on_its_own_sentences(spark):
    texts = ["\n\n".join(L.SENTENCES[s] for s in parts) for _, _, parts in L.RULES]
    found = scan(spark, texts)
    weaker = {w for w, _ in L.MOOT}
    for i, (name, licence, _) in enumerate(L.RULES):
        assert licence in found[i]["licences"].split(","), name
        assert name in found[i]["rules"].split(",") or name in weaker, name


def test_wrapped_header(spark):
    head = APACHE.replace("License at\n#\n#     http", "License at http")
    assert scan(spark, [head])[0]["rules"] == "apache2-header"


def test_own_tables(spark):
    docs = spark.createDataFrame([(1, "First thing. Second thing.")], "doc_id long, text string")
    rules = (("own", "Own-1.0", ("a", "b")), ("turned", "Own-2.0", ("b", "a")))
    out = L.scan_licences(docs, {"a": "First thing.", "b": "Second thing."}, rules, ()).collect()
    assert out[0]["licences"] == "Own-1.0" and out[0]["sentence_ids"] == "a,b"


def test_awkward_rows(awkward, nothing):
    rows = L.scan_licences(awkward).collect()
    assert len(rows) == awkward.count() and all(r["n_known"] == 0 for r in rows)
    assert L.scan_licences(nothing).collect() == []
