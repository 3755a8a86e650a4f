"""License scans by diagonal voting.

All rolling word k-grams of a document are joined by hash to the positions of the same
k-grams in license texts. A hit votes for its diagonal, the word at which the license text
would begin; votes of neighbouring diagonals, which inserted or lost words set apart, are
merged; spans with enough votes are verified word by word on the document itself. Words
that a span lacks, and words that stand between its own, count against it; of spans over
the same words the best stays, so a text is not taken for one that is a part of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resultlake.llm import batches as B
from resultlake.llm import words as W

#: Phrases that are labels by themselves.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Public license texts and notices, in lower-case words, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2.0",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-2.0",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software": "zlib",
}
#: Parts of the BSD licenses.
BSD_HEAD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met {} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer {} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
BSD_NAMES = "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
BSD_TAIL = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages"
#: Versions and kinds of the Creative Commons and GNU licenses.
COMMONS = {"by": "", "by nc": " noncommercial", "by sa": " sharealike", "by nd": " noderivatives", "by nc sa": " noncommercial sharealike", "by nc nd": " noncommercial noderivatives"}
COMMONS_VERSIONS = {"4 0": " international", "3 0": " unported", "2 5": " generic", "2 0": " generic"}
GNU = {"gpl": ("general public license", ("2", "3")), "lgpl": ("lesser general public license", ("2 1", "3")), "agpl": ("affero general public license", ("3",))}

#: Short notices of further licenses, and identifiers that a tag of a source file may name.
SHORT = {
    "cc0 1 0 universal": "cc0-1.0",
    "has waived all copyright and related or neighboring rights to": "cc0-1.0",
    "boost software license version 1 0": "bsl-1.0",
    "eclipse public license v 1 0": "epl-1.0",
    "eclipse public license v1 0": "epl-1.0",
    "eclipse public license version 1 0": "epl-1.0",
    "eclipse public license v 2 0": "epl-2.0",
    "eclipse public license v2 0": "epl-2.0",
    "eclipse public license version 2 0": "epl-2.0",
}
TAG = "spdx license identifier"
IDENTIFIERS = "apache-2.0 mit isc zlib unlicense bsd-2-clause bsd-3-clause mpl-2.0 gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 cc0-1.0 bsl-1.0 epl-1.0 epl-2.0 cc-by-4.0 cc-by-sa-4.0".split()


def license_texts() -> dict[str, str]:
    """The public texts that are looked for, with their labels."""
    out = NOTICES | SHORT | {f"{TAG} {i.replace('-', ' ').replace('.', ' ')}": i for i in IDENTIFIERS}
    out[f"{BSD_HEAD.format('1', '2')} {BSD_TAIL}"] = out[f"{BSD_HEAD.format('', '')} {BSD_TAIL}"] = "bsd-2-clause"
    out[f"{BSD_HEAD.format('1', '2')} 3 {BSD_NAMES} {BSD_TAIL}"] = out[f"{BSD_HEAD.format('', '')} {BSD_NAMES} {BSD_TAIL}"] = "bsd-3-clause"
    for code, words in COMMONS.items():
        for version, tail in COMMONS_VERSIONS.items():
            label = f"cc-{code.replace(' ', '-')}-{version.replace(' ', '.')}"
            out[f"licensed under cc {code} {version}"] = label
            for link in ("", " license"):
                out[f"licensed under a creative commons attribution{words} {version}{tail}{link}"] = label
                out[f"licensed under the creative commons attribution{words} {version}{tail}{link}"] = label
    for label, (name, versions) in GNU.items():
        out[f"licensed under the gnu {name}"] = label
        out[f"this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation"] = label
        for version in versions:
            full = f"{label}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            out[f"licensed under the gnu {name} version {version}"] = full
            out[f"this program is free software you can redistribute it and or modify it under the terms of the gnu {name} as published by the free software foundation either version {version} of the license or at your option any later version"] = full
    return {" ".join(text.split()): label for text, label in out.items()}


#: Words of a k-gram of phrases and of notices.
PHRASE_K, NOTICE_K = 2, 4
#: Diagonals so near to each other are one; share of a notice's k-grams that must vote, and of its words that must be there in order.
NEAR, VOTES, COVERED = 3, 0.5, 0.8

#: Words of all license texts together, whose positions are sent to every task.
MOST_WORDS = 500_000

_SECOND = np.uint64(0x5BD1E9955BD1E995)
_SPANS = "array<struct<label:string,base:boolean,first_word:long,last_word:long,score:double>>"


Template = tuple[list[bytes], str, bool]


def _templates(texts: dict[str, str]) -> list[Template]:
    return [(t.encode().split(), label, base) for table, base in ((PHRASES, True), (texts, False)) for t, label in table.items()]


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = B.buffer(column)
    data = W.LOWER[data]
    return data, *W.spans(data, offsets, W.ALNUM)


def _gram_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, hashes of each text, words of each text): first the short k-grams of a text, then the long."""
    data, starts, ends, counts = _words(column)
    hashed = W.hashes(data, starts, ends)
    short, n_short = W.grams(hashed, counts, PHRASE_K)
    long, n_long = W.grams(hashed, counts, NOTICE_K)
    n = n_short + n_long
    begin = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint64)
    at = np.arange(len(short)) - np.repeat(np.cumsum(n_short) - n_short, n_short)
    out[np.repeat(begin, n_short) + at] = short
    at = np.arange(len(long)) - np.repeat(np.cumsum(n_long) - n_long, n_long)
    out[np.repeat(begin + n_short, n_long) + at] = long ^ _SECOND
    return out.view(np.int64), n, counts


def template_positions(spark: SparkSession, known: list[Template]) -> DataFrame:
    """(hash, template, offset, size, need) of all k-grams of the license texts: as many rows as they have words, about."""
    if sum(len(tokens) for tokens, _, _ in known) > MOST_WORDS:
        raise ValueError(f"license texts of over {MOST_WORDS} words")
    rows = []
    for i, (tokens, _, base) in enumerate(known):
        hashes, n, _ = _gram_lists(pa.array([" ".join(map(bytes.decode, tokens))]))
        k = PHRASE_K if base else NOTICE_K
        size = len(tokens) - k + 1
        own = hashes[:size] if base else hashes[len(hashes) - size :]
        need = size if base else max(1, int(np.ceil(VOTES * size)))
        rows += [(int(h), i, offset, len(tokens), need, base) for offset, h in enumerate(own)]
    return spark.createDataFrame(rows, "hash long, template int, offset int, size int, need int, base boolean")


def _grams(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in B.pieces(it, "text", 2 << 20):
        hashes, n, counts = _gram_lists(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(np.maximum(counts - 1, 0)), B.lists(hashes, n, pa.int64())], ["doc_id", "mark", "n_short", "grams"])


def best(spans: list[dict]) -> list[dict]:
    """Of spans of which more than half lies in better ones only these; ties go to the longer, then the first, then by label."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (-s["score"], s["first_word"] - s["last_word"], s["first_word"], s["label"])):
        own = range(s["first_word"], s["last_word"] + 1)
        taken = {w for o in out for w in range(max(own.start, o["first_word"]), min(own.stop, o["last_word"] + 1))}
        if 2 * len(taken) <= len(own):
            out.append(s)
    return out


def _matched(tokens: list[bytes], there: list[bytes], lo: int, label: str) -> dict | None:
    """The span of a license text among the words from ``lo`` on, if enough of it is there."""
    same = [m for m in SequenceMatcher(None, tokens, there, False).get_matching_blocks() if m.size]
    if not same:
        return None
    own = sum(m.size for m in same)
    first, last = same[0].b, same[-1].b + same[-1].size - 1
    score = own / (len(tokens) + last - first + 1 - own)
    return {"label": label, "base": False, "first_word": lo + first, "last_word": lo + last, "score": score} if score >= COVERED else None


def _verify(known: list[Template]):
    def run(it: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.pieces(it, "text"):
            data, starts, ends, counts = _words(b.column("text"))
            begin = np.cumsum(counts) - counts
            out = []
            for i, found in enumerate(b.column("found").to_pylist()):
                plain, spans = [], []
                for f in found or ():
                    tokens, label, base = known[f["template"]]
                    lo = max(0, f["least"] if base else f["least"] - NEAR)
                    hi = min(int(counts[i]), f["least"] + len(tokens) if base else f["most"] + len(tokens) + NEAR)
                    there = [data[starts[begin[i] + w] : ends[begin[i] + w]].tobytes() for w in range(lo, hi)]
                    if not base:
                        spans.append(_matched(tokens, there, lo, label))
                    elif there == tokens:
                        plain.append({"label": label, "base": True, "first_word": lo, "last_word": hi - 1, "score": 1.0})
                out.append(sorted(plain + best([s for s in spans if s]), key=lambda s: (s["first_word"], s["label"], s["last_word"])))
            kind = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts), pa.array(out, kind)], ["doc_id", "n_words", "spans"])

    return run


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, spans for each row of ``docs``; ``texts`` are license texts with their labels, in lower-case words.

    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. A span has the
    label, whether it is one of the plain phrases, its first and last word and the share of
    the license text that is there. Phrases are found wherever their words stand
    consecutively, overlaps included. Null and empty texts have no words and no spans. Rows
    that share doc_id and text have the same spans. An empty table gives an empty result.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    known = _templates(license_texts() if texts is None else texts)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text).withColumn("mark", F.xxhash64("text"))
    grams = base.mapInArrow(_grams, "doc_id long, mark long, n_short long, grams array<long>")
    hits = grams.select("doc_id", "mark", "n_short", F.posexplode("grams").alias("pos", "hash"))
    hits = hits.join(F.broadcast(template_positions(spark, known)), "hash")  # as small as the license texts
    at = F.when(F.col("base"), F.col("pos")).otherwise(F.col("pos") - F.col("n_short"))
    key = ["doc_id", "mark", "template"]
    votes = hits.select(*key, "size", "need", "base", (at - F.col("offset")).alias("diagonal"), "offset")
    votes = votes.groupBy(*key, "size", "need", "base", "diagonal").agg(F.count_distinct("offset").alias("votes"))
    whole = votes.filter("base AND votes >= need").select(*key, F.col("diagonal").alias("least"), F.col("diagonal").alias("most"))
    order = Window.partitionBy(*key).orderBy("diagonal")
    apart = votes.filter("NOT base").withColumn("new", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(order), F.col("diagonal") - NEAR - 1) > NEAR).cast("int"))
    run = apart.withColumn("run", F.sum("new").over(order)).groupBy(*key, "need", "run").agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("least"), F.max("diagonal").alias("most"))
    found = whole.unionByName(run.filter("votes >= need").select(*key, "least", "most"))
    found = found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("template", "least", "most")).alias("found"))
    found = found.select(F.col("doc_id").alias("id"), F.col("mark").alias("m"), "found")
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m")), "left").select("doc_id", "text", "found")
    return both.mapInArrow(_verify(known), f"doc_id long, n_words long, spans {_SPANS}")


def summary(spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score from :func:`license_spans`."""
    plain = F.filter("spans", lambda s: s["base"])

    def joined(of):
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))))

    starts = F.transform(plain, lambda s: s["first_word"])
    score = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    return spans.select("doc_id", "n_words", F.size(plain).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(plain).alias("base_labels"), joined(F.col("spans")).alias("labels"), score.alias("score"))
