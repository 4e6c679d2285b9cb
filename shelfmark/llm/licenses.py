"""License scan by diagonal voting, in DataFrame functions only.

All rolling word 3-gram hashes of all texts are joined to the places of these 3-grams in the templates (a fixed list,
so broadcast). A hit at word ``p`` of a document and word ``q`` of a template votes for the diagonal ``p - q``; votes are
aggregated per document, template and diagonal, neighbouring diagonals (words put in or left out) are merged, and a
merged span is verified: all words of each hit must equal the template's, and the hits must cover enough of the template
(half, or three quarters of a whole license text).
Templates are the whole texts of short licenses (MIT, ISC, zlib, BSD, BSL and the Unlicense, with their warranty clauses), the
grants of these alone, and the notices by which others are applied.
A text of BSD's three clauses has the label of its two as well.

Fixed base phrases (``cc by``, ``general public license``, ``all rights reserved``) are located word by word besides.
A null text counts as empty: no words, no labels, score 0. Rows, with repeated or null ids too, are labelled by their own
text: spans are joined back by id and text. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import read, text_key, texts

# Words are what these separate; base phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

K, SLACK, LEAST_SHARE, PHRASE_SCORE = 3, 2, 0.5, 0.5
#: 3-grams beyond which a template is a whole license text, and the share of it that a span must cover: a warranty clause
#: that several licenses have names none of them.
WHOLE, WHOLE_SHARE = 90, 0.75

# Wording of public licenses and their usual notices.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "shared under cc by nc 4.0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4.0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4.0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software for more information please refer to http unlicense org"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
]


def _words(text):
    # lower() and lower-casing A-Z part only in words that no phrase or template has.
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def _gram(words, i):
    """The hash of the words from place ``i`` on, and the words."""
    own = [F.get(words, i + j) for j in range(K)]
    return F.xxhash64(*own), F.concat_ws(" ", *own)


def template_places(spark: SparkSession, templates=None) -> DataFrame:
    """``gram, label, template, place, wording, grams`` of every 3-gram of the templates; they are few and fixed."""
    rows = [(i, label, text) for i, (label, text) in enumerate(TEMPLATES if templates is None else templates)]
    words = spark.createDataFrame(rows, "template int, label string, text string").withColumn("words", _words(F.col("text")))
    grams = words.where(F.size("words") >= K).withColumn("grams", F.size("words") - (K - 1))
    places = grams.select("template", "label", "grams", "words", F.explode(F.sequence(F.lit(0), F.col("grams") - 1)).alias("place"))
    gram, wording = _gram(F.col("words"), F.col("place"))
    return places.select("template", "label", "grams", "place", gram.alias("gram"), wording.alias("wording"))


def _rolling(words):
    """An array of ``(gram, wording)`` for each place of a 3-gram."""
    last = F.size(words) - K

    def at(i):
        gram, wording = _gram(words, i)
        return F.struct(gram.alias("gram"), wording.alias("wording"))

    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), at))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, least_share: float = LEAST_SHARE) -> DataFrame:
    """Verified spans: ``doc_id, key`` (a hash of the text), ``label, template, first_word, last_word, share`` (of the
    template's 3-grams)."""
    spark = docs.sparkSession
    row = ["doc_id", "key"]
    rolled = texts(docs, id_col, text_col).select("doc_id", text_key("text").alias("key"), _words(F.col("text")).alias("words"))
    grams = rolled.select(*row, F.posexplode(_rolling(F.col("words"))).alias("at", "g"))
    hits = grams.select(*row, "at", "g.gram", F.col("g.wording").alias("written")).join(F.broadcast(template_places(spark, templates)), "gram")
    hits = hits.where("written = wording").withColumn("diagonal", F.col("at") - F.col("place"))
    votes = hits.groupBy(*row, "template", "label", "grams", "diagonal").agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    by_diagonal = Window.partitionBy(*row, "template").orderBy("diagonal")
    merged = votes.withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > SLACK).cast("int")).withColumn(
        "span", F.sum(F.coalesce("apart", F.lit(0))).over(by_diagonal)
    )
    return (
        merged.groupBy(*row, "template", "label", "grams", "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
            F.min("first").cast("long").alias("first_word"),
            (F.max("last") + (K - 1)).cast("long").alias("last_word"),
        )
        .withColumn("share", F.col("covered") / F.col("grams"))
        .where(F.col("share") >= F.when(F.col("grams") > WHOLE, F.lit(max(least_share, WHOLE_SHARE))).otherwise(least_share))
        .select(*row, "label", "template", "first_word", "last_word", "share")
    )


def _places(words, phrase: str):
    """Word positions where the phrase's words stand consecutively."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    here = lambda i: [F.get(words, i + j) == part for j, part in enumerate(parts)]

    def all_of(i):
        first, *rest = here(i)
        for x in rest:
            first = first & x
        return first

    return F.when(
        (last >= 0) & F.array_contains(words, parts[0]) & F.array_contains(words, parts[-1]),
        F.filter(F.sequence(F.lit(0), last), all_of),
    ).otherwise(F.array().cast("array<int>"))


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per document: words, base phrase places and labels, all labels, and a score.

    The score is the best share of a template that a span covers; a base phrase alone scores ``PHRASE_SCORE``.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", text_key("text").alias("key"), _words(F.col("text")).alias("words"))
    based = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *[_places(F.col("words"), p).alias(f"p{i}") for i, p in enumerate(PHRASES)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values())]))
    based = based.select(
        "doc_id", "key", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.sort_array(labels).alias("base"),
    )
    spans = license_spans(docs, id_col, text_col, templates, least_share)
    found = spans.groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(F.collect_set("label").alias("more"), F.max("share").alias("score"))
    return based.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.col("n_base") > 0, PHRASE_SCORE).otherwise(0.0)).alias("score"),
    )


def op10_license_scan(spark, sf_dir):
    return find_licenses(read(spark, sf_dir, "documents"))
