"""Languages of documents and of the segments of mixed ones (problem 9), by Bayesian evidence fusion.

The evidence for the language of a sentence: its words, under word models of the languages; the label the document
declares, which is right more often than not; and what is usual for the page and the source it is from, the host priors,
smoothed from page to source to the whole. Sentences are told apart after markup, links, ids, signatures and quoted names
are blanked out; neighbours of one language join to a segment.

Two passes: the texts are scored where they are read and leave as a few numbers per document; these meet the priors of
their page, and the second pass fuses the evidence.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entilake.session import cut

#: Labelled documents the word models are fitted on: so many are drawn, by hash, from those of at most TRAIN_CHARS
#: characters. All else covers all documents and whole texts.
TRAIN_DOCUMENTS, TRAIN_CHARS = 6_000, 20_000
#: Languages beyond this number, and word models beyond this size, are refused: both go to every task.
MAX_LANGUAGES, MAX_MODEL_BYTES = 10_000, 256 << 20
#: Least probability of a prior or of a label given a language.
FLOOR = 1e-4
#: Candidates this many nats below the best text likelihood are not kept: a prior and a label outweigh 14 at most.
KEEP_WITHIN = 25.0
#: How often a label that names a language is right, and the weight of a parent in host smoothing, in documents.
LABEL_RIGHT, HOST_WEIGHT = 0.85, 20.0
#: Sentences scored at once; a batch ends after the document that exceeds it.
BATCH_SENTENCES = 5_000
#: Words of the whole sample in each language's model while the sentences of the sample are given to languages.
BACKGROUND = 1_000.0
#: A sentence needs so many known words (letters, in scripts without blanks) and this posterior to start a segment.
LEAST_WORDS, LEAST_LETTERS, SURE = 2, 3, 0.9
#: A quotation of so many words (letters, in scripts without blanks) or less is a name, a longer one running text.
NAME_WORDS, NAME_LETTERS = 4, 20

# Patterns begin with one set of characters, so that the search passes over all others; what follows looks back at it.
_MARKUP = re.compile(r"[<{\[/h&QP](?:(?<=<)/?[A-Za-z!][^<>]*>|(?<=\{)\{[^{}]*\}\}|(?<=\[)\[[^\[\]]*\]\]|(?<=/)\*.*?\*/|(?<=h)ttps?://\S+|(?<=&)[#\w]{1,10};|(?<=[QP])(?<!\w[QP])\d+\b)", re.S)
_SIGNATURE = re.compile(r"--+ ?[^\s.!?]+(?: [^\s.!?]+)? \d{1,2}:\d\d")
#: Opening quotes beside the plain one.
_OPENING = "\u201c\u201d\u201e\u00ab\u300c\u2039\u2018"
_QUOTED = re.compile("[\"\u201c\u201d\u201e\u00ab\u300c\u2039\u2018]([^\"\u201c\u201d\u201e\u00ab\u00bb\u300c\u300d\u203a\u2019\\n.!?\u3002\uff01\uff1f]+)[\"\u201d\u201c\u00bb\u300d\u203a\u2019]")
_CLOSING = "[\")'\u00bb\u201d\\]]*(?=\\s|$)"
_END = re.compile(f"[.!?\u2026\u3002\uff01\uff1f\\n](?:(?<=[.!?\u2026])[.!?\u2026]*{_CLOSING}|(?<=[\u3002\uff01\uff1f])[\u3002\uff01\uff1f]*[\u300d\uff09]*|(?<=\\n)\\n*)")
#: The same for texts without wide marks, where it is the faster one.
_PLAIN_END = re.compile(f"[.!?\\n](?:(?<=[.!?])[.!?]*{_CLOSING}|(?<=\\n)\\n*)")
_WIDE_MARKS = "\u3002\uff01\uff1f\u2026"
_WORD = re.compile(r"[^\W\d_]+")
#: Scripts written without blanks: kana, Han, Thai. Their units are letters and pairs of letters.
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u9fff\u0e00-\u0e7f]")


def _is_name(quoted: str) -> bool:
    return len(quoted.split()) <= NAME_WORDS and (len(quoted) <= NAME_LETTERS or len(_UNSPACED.findall(quoted)) <= NAME_LETTERS)


def blanked(text: str) -> str:
    """The text with all that is no running text replaced by as many blanks; signatures end a sentence."""
    wide = lambda m: " " * len(m.group())
    text = _MARKUP.sub(wide, text)
    if "--" in text:
        text = _SIGNATURE.sub(lambda m: "\n" * len(m.group()), text)
    if '"' in text or not text.isascii() and any(q in text for q in _OPENING):
        text = _QUOTED.sub(lambda m: wide(m) if _is_name(m.group(1)) else m.group(), text)
    return text


def sentence_ends(text: str) -> list[int]:
    """Ends of the sentences and lines of a blanked text, in order; each begins where the one before ends."""
    pattern = _PLAIN_END if text.isascii() or not any(m in text for m in _WIDE_MARKS) else _END
    ends = [m.end() for m in pattern.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return ends


@lru_cache(maxsize=200_000)
def fold(word: str) -> str:
    """Lower case without marks, so that texts written without them count as the same words."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c)) or word


def units(text: str) -> list[str]:
    """The words of a text, folded; letters and pairs of letters of unspaced scripts."""
    found: list[str] = []
    for w in _WORD.findall(text):
        if w.isascii():
            found.append(w.lower())
        elif _UNSPACED.search(w):
            run = "".join(c for c in w if _UNSPACED.match(c))
            found += run
            found += map("".join, zip(run, run[1:]))
        else:
            found.append(fold(w))
    return found


#: Added to every count of a word in a language.
FEW = 0.02


def _spans(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of `rows` in a list of lists that begin at `first`, one after the other, and their numbers."""
    size = first[rows + 1] - first[rows]
    ends = np.cumsum(size)
    return np.repeat(first[rows] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0), size


class Tokens:
    """What stands between two blanks, by number, with its known words. Forgotten when there are too many."""

    MOST = 300_000

    def __init__(self, ids: dict[str, int]) -> None:
        self.ids = ids
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.first, self.words, self.unspaced = [0], [], []

    def numbers(self, tokens: list[str]) -> list[int]:
        found = list(map(self.number.get, tokens))
        return [self._learn(t) if f is None else f for t, f in zip(tokens, found)] if None in found else found

    def _learn(self, token: str) -> int:
        n = self.number.get(token)
        if n is None:
            n = self.number[token] = len(self.unspaced)
            self.words += [k for k in map(self.ids.get, units(token)) if k is not None]
            self.first.append(len(self.words))
            self.unspaced.append(not token.isascii() and _UNSPACED.search(token) is not None)
        return n


class WordModel:
    """P(word | language) for the words of the sample; words it does not know say nothing. A word is kept with the languages
    it was counted in; in all others it has the rate of FEW."""

    def __init__(self, words: list[str], counts: np.ndarray) -> None:
        self.live = np.flatnonzero(counts.sum(axis=0)).astype(np.int32)
        self.ids = {w: i for i, w in enumerate(words)}
        mine = counts[:, self.live]
        self.base = np.log(FEW) - np.log(mine.sum(axis=0) + FEW * (len(words) + 1))
        word, self.lang = (x.astype(np.int32) for x in np.nonzero(mine))
        self.gain = (np.log(mine[word, self.lang] + FEW) - np.log(FEW)).astype(np.float32)
        self.first = np.searchsorted(word, np.arange(len(words) + 1)).astype(np.int64)
        if self.size() > MAX_MODEL_BYTES:
            raise ValueError("the word model is too large for every task; draw fewer documents")

    def size(self) -> int:
        """Bytes, roughly."""
        return self.gain.nbytes + self.lang.nbytes + self.first.nbytes + sum(100 + len(w) for w in self.ids)

    def score(self, words: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """Log likelihood of each live language (columns) for n sentences, given known words and the sentences they are in."""
        at, size = _spans(self.first, words)
        k = len(self.live)
        gained = np.bincount(np.repeat(sentence, size) * k + self.lang[at], self.gain[at], n * k).reshape(n, k)
        return gained + np.bincount(sentence, minlength=n)[:, None] * self.base


def _log_rates(counts: np.ndarray, background: float) -> np.ndarray:
    """Log rates of words (rows) in languages (columns), with so many words of the whole sample added to each."""
    usual = counts.sum(axis=1, keepdims=True) / max(1.0, counts.sum())
    return np.log((counts + FEW + background * usual) / (counts.sum(axis=0) + FEW * (len(counts) + 1) + background))


def fit(documents: list[tuple[str, int]], n_languages: int, rounds: int = 2) -> WordModel:
    """Word model from (text, label) with some wrong labels. First each word votes for its labels, so that a label that is
    mostly a mistake for a larger language loses that language's words to it; the sentences are given to the winners, and
    the counts of the sentences so labelled are the model, refined in `rounds`. There a sentence is judged by what the other
    documents say and by its label, so that no document is a language of its own."""
    words: dict[str, int] = {}
    ids: list[int] = []
    starts, sentence_doc = [], []
    for d, (text, _) in enumerate(documents):
        clean = blanked(text)
        ends = sentence_ends(clean)
        for a, b in zip([0, *ends], ends):
            found = units(clean[a:b])
            if found:
                starts.append(len(ids))
                sentence_doc.append(d)
                ids += [words.setdefault(w, len(words)) for w in found]
    v, n_sentences = len(words), len(starts)
    if not n_sentences:
        return WordModel([], np.zeros((0, n_languages)))
    token = np.array(ids, dtype=np.int64)
    start, doc = np.array(starts), np.array(sentence_doc, dtype=np.int64)
    of_sentence = np.repeat(np.arange(n_sentences), np.diff(np.append(start, len(token))))
    label = np.array([k for _, k in documents], dtype=np.int64)[doc]

    def counted(given: np.ndarray) -> np.ndarray:
        return np.bincount(token * n_languages + given[of_sentence], minlength=v * n_languages).reshape(v, n_languages).astype(np.float64)

    def summed(rates: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(of_sentence, rates[token, k], n_sentences) for k in range(n_languages)], axis=1)

    # A document's vote on a word grows with the logarithm of its uses, so that a very long one does not outvote the rest.
    once, uses = np.unique(doc[of_sentence] * v + token, return_counts=True)
    voter = np.array([k for _, k in documents], dtype=np.int64)[once // v]
    votes = np.bincount(once % v * n_languages + voter, 1 + np.log(uses), minlength=v * n_languages).reshape(v, n_languages)
    vote = np.log((votes + 0.05) / (votes.sum(axis=1, keepdims=True) + 0.05 * n_languages))
    declares = math.log(LABEL_RIGHT * max(1, n_languages - 1) / (1 - LABEL_RIGHT))
    every = np.arange(n_sentences)
    scores = summed(vote)
    scores[every, label] += 1.0  # where the words of a sentence are in few documents, its own label decides
    given = scores.argmax(axis=1)
    for _ in range(rounds):
        counts = counted(given)
        scores = summed(_log_rates(counts, BACKGROUND))
        # The document's own counts of each word, and in all, in the language its sentence is given to.
        _, at, own = np.unique((doc[of_sentence] * n_languages + given[of_sentence]) * v + token, return_inverse=True, return_counts=True)
        _, group, size = np.unique((doc * n_languages + given)[of_sentence], return_inverse=True, return_counts=True)
        k = given[of_sentence]
        usual = counts.sum(axis=1)[token] / max(1.0, counts.sum())
        rest = counts.sum(axis=0)[k] - size[group] + FEW * (v + 1) + BACKGROUND
        scores[every, given] = np.bincount(of_sentence, np.log((counts[token, k] - own[at] + FEW + BACKGROUND * usual) / rest), n_sentences)
        scores += np.log(np.bincount(given, minlength=n_languages) + 1.0)
        scores[every, label] += declares
        scores[:, np.bincount(given, minlength=n_languages) == 0] = -np.inf
        given = scores.argmax(axis=1)
    return WordModel(list(words), counted(given))


def label_index(languages: DataFrame) -> tuple[list[str], dict[str, int]]:
    """Codes in order, and the position of the language by each of its names (code, tag, iso3, title; lower case). A name
    that two languages share is that of the first. More than MAX_LANGUAGES rows are refused."""
    rows = languages.where(F.col("code") != "").select("code", "tag", "iso3", "english_title").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes = sorted({r["code"] for r in rows})
    at = {c: k for k, c in enumerate(codes)}
    names: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: tuple(x or "" for x in r)):
        for n in (r["code"], r["tag"], r["iso3"], r["english_title"]):
            if n and n.strip():
                names.setdefault(n.strip().lower(), at[r["code"]])
    return codes, names


def with_label(docs: DataFrame, lang: str, names: dict[str, int], label: str = "label") -> DataFrame:
    """`docs` with the position of the language its label names, with or without a region; NULL if it names none."""
    table = docs.sparkSession.createDataFrame(sorted(names.items()) or [("", None)], "_name string, _k int")
    text = F.lower(F.btrim(lang, F.lit(" \t\n\r\f\v")))
    whole, part = (F.broadcast(table.select(F.col("_name").alias(f"_n{i}"), F.col("_k").alias(f"_k{i}"))) for i in (0, 1))
    named = docs.withColumn("_whole", text).withColumn("_part", F.when(F.col("_whole").contains("-") | F.col("_whole").contains("_"), F.regexp_extract("_whole", r"^(\w+?)[-_]\w+$", 1)))
    named = named.join(whole, F.col("_whole") == F.col("_n0"), "left").join(part, F.col("_part") == F.col("_n1"), "left")
    return named.withColumn(label, F.coalesce("_k0", "_k1")).drop("_whole", "_part", "_n0", "_n1", "_k0", "_k1")


def training_sample(docs: DataFrame, n_labelled: int) -> list[tuple[str, int]]:
    """TRAIN_DOCUMENTS documents, in expectation, with a label; drawn by a hash of their id among those of TRAIN_CHARS
    characters at most, so the driver gets no more than twice as many texts of that length."""
    usable = docs.where(F.col("label").isNotNull() & (F.length("text") <= TRAIN_CHARS)).select("doc_id", "text", "label")
    part = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id"), 1) < min(2**63 - 1, int(2**63 * (TRAIN_DOCUMENTS / max(n_labelled, 1))))
    rows = (usable.where(part) if n_labelled > TRAIN_DOCUMENTS else usable).limit(2 * TRAIN_DOCUMENTS).collect()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"]))]


#: A run of sentences: neighbours that only one language can have (one candidate), or one sentence with the languages that
#: are within KEEP_WITHIN of the best. strong: whether it has enough known words to start a segment.
RUN = T.StructType().add("start", "integer").add("stop", "integer").add("m", "integer").add("strong", "boolean").add("lang", T.ArrayType(T.IntegerType())).add("ll", T.ArrayType(T.FloatType()))


def _lists(starts: np.ndarray, total: int) -> pa.Array:
    return pa.array(np.append(starts, total).astype(np.int32))


def scored_runs(docs: DataFrame, model: WordModel) -> DataFrame:
    """doc_id, source, page, label, runs ARRAY<RUN>: the sentences of each text with a known word. No shuffle; texts go no
    further."""
    source = docs.select("doc_id", "source", "page", "label", "text")
    out = T.StructType([*source.schema.fields[:4], T.StructField("runs", T.ArrayType(RUN))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, model = to_arrow_schema(out), shared.value
        kind, tokens = schema.field("runs").type, Tokens(model.ids)
        for batch in batches:
            done = 0
            ends, sizes, per_doc, met = [], [], [], []  # of sentences: end, tokens; sentences of each document; tokens

            def flush(upto: int, batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                doc = np.repeat(np.arange(done, upto), per_doc)
                b, size, token = np.array(ends, dtype=np.int64), np.array(sizes, dtype=np.int64), np.array(met, dtype=np.int64)
                a = np.concatenate([[0], b[:-1]])[: len(b)]
                a[1:][doc[1:] != doc[:-1]] = 0
                opening = np.cumsum(size) - size
                unspaced = np.zeros(len(b), dtype=bool)
                unspaced[size > 0] = np.array(tokens.unspaced, dtype=bool)[token[opening[size > 0]]]
                at, words = _spans(np.array(tokens.first, dtype=np.int64), token)
                of = np.repeat(np.repeat(np.arange(len(b)), size), words)
                told = np.bincount(of, minlength=len(b))
                kept = np.flatnonzero(told)
                n = len(kept)
                place = np.cumsum(told > 0) - 1
                ll = model.score(np.array(tokens.words, dtype=np.int64)[at], place[of], n) if n else np.zeros((0, max(1, len(model.live))))
                doc, a, b, told, unspaced = (x[kept] for x in (doc, a, b, told, unspaced))
                ll -= ll.max(axis=1, keepdims=True)
                near = ll >= -KEEP_WITHIN
                strong = told >= np.where(unspaced, LEAST_LETTERS, LEAST_WORDS)
                alone = (near.sum(axis=1) == 1) & strong
                best = ll.argmax(axis=1)
                same = np.zeros(n, dtype=bool)
                same[1:] = alone[1:] & alone[:-1] & (doc[1:] == doc[:-1]) & (best[1:] == best[:-1])
                first = np.flatnonzero(~same)
                last = np.append(first[1:], n) - 1 if n else first
                row, column = np.nonzero(near[first])
                offsets = _lists(np.searchsorted(row, np.arange(len(first))), len(row))
                fields = [pa.array(a[first].astype(np.int32)), pa.array(b[last].astype(np.int32)), pa.array((last - first + 1).astype(np.int32)), pa.array(strong[first]), pa.ListArray.from_arrays(offsets, pa.array(model.live[column])), pa.ListArray.from_arrays(offsets, pa.array(ll[first][row, column].astype(np.float32)))]
                each = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(fields, kind.value_type)], fields=list(kind.value_type))
                found = pa.ListArray.from_arrays(_lists(np.searchsorted(doc[first], np.arange(done, upto)), len(first)), each).cast(kind)
                if len(tokens.unspaced) > tokens.MOST:
                    tokens.clear()
                return pa.RecordBatch.from_arrays([*batch.slice(done, upto - done).columns[:4], found], schema=schema)

            for i, text in enumerate(batch.column(4).to_pylist()):
                clean = blanked(text or "")
                found = sentence_ends(clean)
                pieces = [clean[s:e].split() for s, e in zip([0, *found], found)]
                met += tokens.numbers(list(chain.from_iterable(pieces)))
                sizes += map(len, pieces)
                ends += found
                per_doc.append(len(found))
                if len(ends) >= BATCH_SENTENCES:
                    yield flush(i + 1)
                    done = i + 1
                    ends, sizes, per_doc, met = [], [], [], []
            if done < batch.num_rows:
                yield flush(batch.num_rows)

    return source.mapInArrow(run, out)


def host_counts(labelled: DataFrame) -> DataFrame:
    """(source, page, n_docs, page_labels, source_labels): how many documents a page has, and how often the labels on it and
    on its source name each language, as ARRAY<STRUCT<k, n>>. By grouped sums over all documents (columns source, page,
    label); every page has a row. A hot page or source is one row per label and task in each shuffle."""
    per = labelled.groupBy("source", "page", "label").agg(F.count("*").alias("n"))
    listed = lambda: F.collect_list(F.when(F.col("label").isNotNull(), F.struct(F.col("label").alias("k"), "n")))
    pages = per.groupBy("source", "page").agg(F.sum("n").alias("n_docs"), listed().alias("page_labels"))
    sources = per.groupBy("source", "label").agg(F.sum("n").alias("n")).groupBy("source").agg(listed().alias("source_labels"))
    return pages.join(sources, "source")


#: A page is split when it has more documents than all documents divided by this, so at most so many are split.
MOST_SPLIT = 256


def at_hosts(scored: DataFrame, hosts: DataFrame, n_docs: int) -> DataFrame:
    """Documents with the counts of their page. A page with more than n_docs / MOST_SPLIT documents is split by a hash of
    the document, and its counts are repeated for each part; at most MOST_SPLIT pages are."""
    limit = max(100_000, -(-n_docs // MOST_SPLIT))
    parts = F.ceil(F.col("n_docs") / limit).cast("int")
    hot = F.broadcast(hosts.where(F.col("n_docs") > limit).select("source", "page", parts.alias("_parts")).limit(MOST_SPLIT))
    salted = scored.join(hot, ["source", "page"], "left").withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    copies = hosts.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n_docs")
    return salted.join(copies, ["source", "page", "_salt"])


def _dense(counts: pa.Array, n: int) -> np.ndarray:
    """Counts per language of each row of an ARRAY<STRUCT<k, n>>."""
    offsets, flat = counts.offsets.to_numpy(), counts.values
    row = np.repeat(np.arange(len(counts)), np.diff(offsets))
    k, m = (flat.field(f).to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] for f in ("k", "n"))
    return np.bincount(row * n + k, m, len(counts) * n).reshape(len(counts), n)


def fused(at: DataFrame, base: np.ndarray, codes: list[str]) -> DataFrame:
    """doc_id, label, lang_code, confidence, segments ARRAY<STRUCT<start, stop, lang_code, confidence>>.

    A sentence's posterior is made of the likelihood of its words, of the label, and of the prior of its page, from which
    the document's own label is taken out. A run of one language with enough words and a posterior of SURE starts a segment,
    which goes on to the next; its confidence is the mean posterior of its sentences. A document with weaker sentences only
    is one segment, of the language that fits all of them together, with that posterior. lang_code is the language with
    most characters in the segments, confidence theirs times its share of them; without any segment, of a text without
    known words, both come from label and prior alone, and with no language in any label both are NULL. `base`: the share
    of each language in all labels, NULL labels not counted."""
    n = len(codes)
    piece = T.StructType().add("start", "integer").add("stop", "integer").add("lang_code", "string").add("confidence", "double")
    source = at.select("doc_id", "label", "runs", "page_labels", "source_labels")
    out = T.StructType([*source.schema.fields[:2], T.StructField("lang_code", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("segments", T.ArrayType(piece))])
    wrong = max(FLOOR, (1 - LABEL_RIGHT) / max(1, n - 1))

    def evidence(label: np.ndarray, page: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Log prior plus log likelihood of the label, per document and language."""
        rows = np.flatnonzero(label >= 0)
        for counts in (page, source):
            counts[rows, label[rows]] -= 1
        total = lambda x: x.sum(axis=1, keepdims=True)
        of_source = (source + HOST_WEIGHT * base) / (total(source) + HOST_WEIGHT)
        logs = np.log(np.maximum(FLOOR, (page + HOST_WEIGHT * of_source) / (total(page) + HOST_WEIGHT)))
        logs[rows] += math.log(wrong)
        logs[rows, label[rows]] += math.log(LABEL_RIGHT / wrong)
        return logs

    def told(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
        docs = batch.num_rows
        label = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        usual = evidence(label, _dense(batch.column(3), n), _dense(batch.column(4), n))
        runs = batch.column(2)
        at0, at1 = runs.offsets[0].as_py(), runs.offsets[-1].as_py()
        flat = runs.values.slice(at0, at1 - at0)
        first_run = runs.offsets.to_numpy() - at0
        start, stop, m, strong = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
        doc = np.repeat(np.arange(docs), np.diff(first_run))
        cands = flat.field(4)
        first = cands.offsets.to_numpy()[: len(flat) + 1]
        lang = cands.values.to_numpy()[first[0] : first[-1]].astype(np.int64) if len(flat) else np.zeros(0, np.int64)
        ll = flat.field(5).values.to_numpy()[first[0] : first[-1]].astype(np.float64) if len(flat) else np.zeros(0)
        first = first - first[0] if len(first) else first
        size = np.diff(first)
        run = np.repeat(np.arange(len(flat)), size)
        v = ll + usual[doc[run], lang]
        best = np.maximum.reduceat(v, first[:-1]) if len(flat) else np.zeros(0)
        p = 1 / np.bincount(run, np.exp(v - best[run]), len(flat)) if len(flat) else np.zeros(0)
        top = np.flatnonzero(v == best[run])
        chosen = np.zeros(len(flat), dtype=np.int64)
        chosen[run[top[::-1]]] = lang[top[::-1]]
        sure = strong & (p >= SURE)
        # Documents without a sure sentence: all their sentences together.
        weak = np.bincount(doc, sure, docs) == 0
        together = usual.copy()
        inside = weak[doc[run]]
        np.add.at(together, (doc[run][inside], lang[inside]), (ll[inside] + KEEP_WITHIN))
        together -= together.max(axis=1, keepdims=True, initial=-np.inf)
        whole = together.argmax(axis=1) if n and docs else np.zeros(docs, dtype=np.int64)
        whole_p = 1 / np.exp(together).sum(axis=1)
        known = np.diff(first_run) > 0
        # Segments: of sure runs, neighbours of one language joined, and one for each weak document with known words.
        keep = np.flatnonzero(sure)
        new = np.ones(len(keep), dtype=bool)
        new[1:] = (doc[keep][1:] != doc[keep][:-1]) | (chosen[keep][1:] != chosen[keep][:-1])
        group = np.cumsum(new) - 1
        s_run = keep[new]
        s_doc, s_lang, s_start = doc[s_run], chosen[s_run], start[s_run].astype(np.int64)
        count = np.bincount(group, m[keep], len(s_run))
        s_p = np.bincount(group, (p * m)[keep], len(s_run)) / np.maximum(1, count)
        opening = np.ones(len(s_run), dtype=bool)
        opening[1:] = s_doc[1:] != s_doc[:-1]
        s_start[opening] = start[first_run[s_doc[opening]]]
        closing = np.append(s_run[1:], len(flat)) - 1
        closing = np.minimum(closing, first_run[s_doc + 1] - 1) if len(s_run) else closing
        s_stop = stop[closing].astype(np.int64) if len(s_run) else np.zeros(0, np.int64)
        lone = np.flatnonzero(weak & known)
        order = np.argsort(np.concatenate([s_doc, lone]), kind="stable")
        s_start = np.concatenate([s_start, start[first_run[lone]]])[order].astype(np.int64)
        s_stop = np.concatenate([s_stop, stop[first_run[lone + 1] - 1]])[order].astype(np.int64)
        s_lang, s_p = np.concatenate([s_lang, whole[lone]])[order], np.concatenate([s_p, whole_p[lone]])[order]
        s_doc = np.concatenate([s_doc, lone])[order]
        # The document: the language with most characters in its segments, the first one of equals.
        chars = np.bincount(s_doc * n + s_lang, s_stop - s_start, docs * n).reshape(docs, n)
        trust = np.bincount(s_doc * n + s_lang, (s_stop - s_start) * s_p, docs * n).reshape(docs, n)
        main = np.where(known, chars.argmax(axis=1) if n and docs else 0, whole)
        share = np.where(known, trust[np.arange(docs), main] / np.maximum(1, chars.sum(axis=1)), whole_p)
        names = pa.array(codes, pa.string())
        offsets = _lists(np.searchsorted(s_doc, np.arange(docs)), len(s_doc))
        fields = [pa.array(s_start.astype(np.int32)), pa.array(s_stop.astype(np.int32)), names.take(pa.array(s_lang)), pa.array(s_p)]
        kind = schema.field("segments").type
        each = pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(fields, kind.value_type)], fields=list(kind.value_type))
        told_of = known | (base.sum() > 0)
        main_code = names.take(pa.array(main, mask=~told_of))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], main_code, pa.array(share, mask=~told_of), pa.ListArray.from_arrays(offsets, each).cast(kind)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            if batch.num_rows:
                yield told(batch, schema)

    return source.mapInArrow(run, out)


def identify(docs: DataFrame, languages: DataFrame) -> DataFrame:
    """Language, confidence and segments of all documents (see `fused`), with label_code, the language the label names.

    docs: doc_id, text, lang, source, page_title; any of them may be NULL, other columns are ignored. Whole texts are read,
    whatever their length. Languages without a name in any label of the sample cannot be found in a text; without any
    languages nothing is told. Labels, pages and counts take one scan without the texts, the sample one, the texts one."""
    codes, names = label_index(languages)
    keyed = docs.select("doc_id", F.lower(F.trim(F.coalesce("source", F.lit("")))).alias("source"), F.coalesce("page_title", F.lit("")).alias("page"), "lang", "text")
    keyed = with_label(keyed, "lang", names).select("doc_id", "source", "page", F.col("label").cast("int").alias("label"), "text")
    if not codes:
        none = F.lit(None)
        empty = F.array().cast("array<struct<start:int,stop:int,lang_code:string,confidence:double>>")
        return keyed.select("doc_id", none.cast("string").alias("lang_code"), none.cast("double").alias("confidence"), empty.alias("segments"), none.cast("string").alias("label_code"))
    hosts = cut(host_counts(keyed.drop("text", "doc_id")))
    n_docs = hosts.agg(F.sum("n_docs")).first()[0] or 0
    sums = hosts.select(F.explode("page_labels").alias("l")).groupBy("l.k").agg(F.sum("l.n").alias("n")).collect()  # a row per language
    base = np.zeros(len(codes))
    for r in sums:
        base[r["k"]] = r["n"]
    labelled = int(base.sum())
    base = (base + 0.1) / (labelled + 0.1 * len(codes)) if labelled else base
    model = fit(training_sample(keyed, labelled), len(codes))
    found = fused(at_hosts(scored_runs(keyed, model), hosts, n_docs), base, codes)
    return found.withColumn("label_code", F.get(F.array(*[F.lit(c) for c in codes]), F.col("label"))).drop("label")
