"""Token counts without token ids.

Distinct pre-tokens of all texts are gathered with their frequencies, each is counted in pieces once, and the counts are
joined to the pre-token frequencies of each document and summed. The join has two parts with one result: pre-tokens of
the most frequent classes, at most `head` of them, go to every task as a dictionary; all others are joined by a shuffle,
where none is frequent. Keys longer than LONG bytes are replaced by a digest, so the dictionary has at most head * LONG
bytes. Null text counts as empty; repeated rows and null ids keep their rows; other columns are not read; an empty table
gives none. Of a very long text one copy and its frequencies are in memory.
"""
import hashlib
import json
import operator
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docloom.llm.shared import stored

CACHE = 300_000  # entries after which the memo starts anew; results do not depend on it
HEAD, LONG, CUT = 300_000, 64, 50_000  # most pre-tokens sent to every task, their bytes, rows of a batch

def parts(path: str) -> tuple[str, list[str]]:
    """The pre-token pattern and the special strings of a vocabulary file; one of another build is refused, as its counts would be wrong."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre = (d.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split, extra = pre[0] if pre else {}, d.get("added_tokens", [])
    blanks = [x for x in (d.get("normalizer") or {}).get("normalizers", []) if x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " "]
    fits = [x["type"] for x in pre] == ["Split", "ByteLevel"] and split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"] and not pre[1]["add_prefix_space"]
    if not fits or not blanks or d["model"]["type"] != "BPE" or any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["content"].split() != [x["content"]] for x in extra):
        raise ValueError(f"{path} is built in a way that is not known here")
    return split["pattern"]["Regex"], sorted((x["content"] for x in extra), key=len, reverse=True)


class _Splitter:
    """Pre-tokens of what stands between two blanks: none crosses a blank, and neither does the normaliser."""

    def __init__(self, path):
        import regex
        from tokenizers import Tokenizer

        self.normal = Tokenizer.from_file(path).normalizer
        pattern, special = parts(path)
        self.piece = regex.compile(pattern)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")

    def normalised(self, words):
        """Printable words hold no blank, so they are normalised in one text; the others one by one."""
        plain = [w for w in words if w and w.isprintable()]
        out = dict(zip(plain, self.normal.normalize_str(" ".join(plain)).split(" ")))
        return [out[w] if w in out else self.normal.normalize_str(w) for w in words]

    def count(self, words):
        """How often each pre-token comes in the words."""
        return Counter(x for p in self.special.split(b" ".join(words).decode()) for x in self.piece.findall(self.normal.normalize_str(p)))

    def split(self, words):
        """For each word the number of its special strings and its pre-tokens."""
        text = b" ".join(words).decode()
        if text.isprintable() and not self.special.search(text):
            return [(0, xs) for xs in map(self.piece.findall, self.normal.normalize_str(text).split(" "))]
        whole = [self.special.split(w.decode()) for w in words]
        every = list(dict.fromkeys(p for ps in whole for p in ps))
        pieces = dict(zip(every, map(self.piece.findall, self.normalised(every))))
        return [(len(ps) - 1, pieces[ps[0]] if len(ps) == 1 else [x for p in ps for x in pieces[p]]) for ps in whole]


def _words(text):
    """bytes.split knows the ASCII blanks only; other blanks stay inside a word and are left to the normaliser."""
    return text.encode().split()


def _key(x):
    return x if len(x) <= LONG // 4 or len(raw := x.encode()) <= LONG else "\0" + hashlib.blake2b(raw, digest_size=16).hexdigest()


def pre_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(key, freq, pieces) of each distinct pre-token of all texts."""

    def gather(batches):
        splitter, freq = _Splitter(path), Counter()

        def flush():
            same, out = defaultdict(list), Counter()  # words of one frequency are split in one text
            for w, n in freq.items():
                same[n].append(w)
            freq.clear()
            for n, words in same.items():
                for i in range(0, len(words), CUT):
                    for x, k in splitter.count(words[i : i + CUT]).items():
                        out[x] += n * k
            xs, ns = list(out), list(out.values())
            for i in range(0, len(xs), CUT):
                yield pa.RecordBatch.from_arrays([pa.array(xs[i : i + CUT], pa.string()), pa.array(ns[i : i + CUT], pa.int64())], ["x", "freq"])

        for b in batches:
            for t in b.column(0):
                freq.update(_words(t.as_py()))
                if len(freq) > CACHE:
                    yield from flush()
        yield from flush()

    def measure(batches):
        from tokenizers import Tokenizer, pre_tokenizers

        bpe, plain = Tokenizer.from_file(path).model, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        for b in batches:
            xs = b.column(0).to_pylist()
            # printable ASCII is its own byte-level form
            n = [len(bpe.tokenize(x if x.isascii() and x.isprintable() else plain(x)[0][0])) for x in xs]
            yield pa.RecordBatch.from_arrays([pa.array(map(_key, xs), pa.string()), b.column(1), pa.array(n, pa.int64())], ["key", "freq", "pieces"])

    found = docs.where("text is not null").select("text").mapInArrow(gather, "x string, freq long")
    return found.groupBy("x").agg(F.sum("freq").alias("freq")).mapInArrow(measure, "key string, freq long, pieces long")


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, head: int = HEAD) -> DataFrame:
    table = stored(pre_tokens(docs, path).withColumn("class", F.floor(F.log2("freq") * 16).cast("int")))
    least, left = 1 << 30, head  # classes of frequency, at most 1,024 rows
    for r in table.groupBy("class").count().orderBy(F.desc("class")).collect():
        left -= r["count"]
        if left < 0:
            break
        least = r["class"]
    often = table.where(F.col("class") >= least).select("key", "pieces").toArrow()
    often = dict(zip(often["key"].to_pylist(), often["pieces"].to_pylist()))

    def run(batches):
        splitter, known, rare, at = _Splitter(path), {}, {}, TaskContext.get().partitionId() << 40

        def learn(words):
            for w, (n, xs) in zip(words, splitter.split(words)):
                odd = []
                for x in xs:
                    if (p := often.get(x)) is None and (p := often.get(k := _key(x))) is None:
                        odd.append(k)
                    else:
                        n += p
                known[w] = n
                if odd:
                    rare[w] = odd

        for b in batches:
            row, id_, size, key, n = [], [], [], [], []
            for t, i, bytes_ in zip(b.column(1), b.column(0).to_pylist(), b.column(2).to_pylist()):
                freq = Counter(_words(t.as_py()))
                if len(known) > CACHE:
                    known.clear()
                    rare.clear()
                if new := [w for w in freq if w not in known]:
                    learn(new)
                odd = Counter()
                for w in freq.keys() & rare.keys():
                    for k in rare[w]:
                        odd[k] += freq[w]
                row += [at] * (1 + len(odd))
                id_ += [i] + [None] * len(odd)
                size += [bytes_] + [None] * len(odd)
                key += [None, *odd]
                n += [sum(map(operator.mul, map(known.__getitem__, freq), freq.values())), *odd.values()]
                at += 1
                if len(row) >= CUT:
                    yield batch(row, id_, size, key, n)
                    row, id_, size, key, n = [], [], [], [], []
            yield batch(row, id_, size, key, n)

    def batch(row, id_, size, key, n):
        long = pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(row, long), pa.array(id_, long), pa.array(size, long), pa.array(key, pa.string()), pa.array(n, long)], ["row", "doc_id", "n_bytes", "key", "n"])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    # one row a document, and one for each of its rare pre-tokens; written, so that numbers of rows hold when a task runs again
    rows = stored(rows.mapInArrow(run, "row long, doc_id long, n_bytes long, key string, n long"))
    more = rows.where("key is not null").join(table.where(F.col("class") < least).select("key", "pieces"), "key")
    more = more.groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n = (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    every = rows.where("key is null").select("row", "doc_id", "n_bytes", "n").join(more, "row", "left")
    return every.select("doc_id", "n_bytes", n).withColumn("over_limit", F.col("n_tokens") > limit)
