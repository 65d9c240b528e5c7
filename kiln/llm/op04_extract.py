"""Main text of web pages by union-free wrappers of hosts.

1. Every page becomes a stream of block tags (with the words of class, id and
   role) and text slots; adjacent equal runs of tokens are folded into one
   repeated group ``(...)+``. Pages of a host share few such skeletons; each
   distinct one is kept once, with the amount of text and the least and greatest
   text hash of its slots (partial aggregation).
2. Per host the skeletons, dealt over ``PARTS`` groups, are aligned one after the
   other with the group's wrapper so far, then the groups' wrappers with each
   other. Text against text is a slot; tokens that only one side has become
   optional ``(...)?``; what then repeats next to itself is folded again. The
   result is a regular expression without unions.
3. Skeletons are matched against their host's expression, so every slot has a
   place in it, and the slots' figures are added up by place.
4. Per host the places to take are chosen: those inside the main container, which
   is the article (or main) element with the most text, else the innermost
   container with most of the text that varies by page; not inside menus, page
   headers, footers, sidebars, notices, adverts, forms or reader comments, told by
   element and by the words of class, id and role. Where no article (or main)
   element marks the container, places whose text is the same on all of at least
   ``SAME_PAGES`` pages that differ elsewhere are the template's, and are not taken.
   Inside an article element such text is kept: it may be copied content.
5. Every page is matched against its host's expression, and its slots at places
   to take are its text. A place whose containers differ from page to page is
   decided by the slot's own container; a page without any slot in the host's main
   container by its own main container.

Blocks are separated by block tags. Scripts and styles are never read.

Defined results: null or empty pages have the empty text; pages whose url is
null or has no host share one wrapper; repeated rows are extracted one by one;
extra columns are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache, reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, stored
from kiln.llm.textbytes import bound_batches

# What HTML calls blocks, raw text and void elements, and words that name parts beside the article.
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
            "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre section "
            "summary table tbody td tfoot th thead tr ul title option".split())
CONTAINER = BLOCK - set("p h1 h2 h3 h4 h5 h6 hr title".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
LEFT_OUT = set("nav footer aside form script style noscript template iframe svg button select textarea dialog menu "
               "canvas object embed audio video head xmp noembed noframes".split())
BESIDE = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
             "gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
             "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header masthead footer copyright share "
             "sharing social related recommended comment comments commentlist disqus respond replies reply widget widgets "
             "toolbar pagination pager search form".split())
MAIN_WORDS = set("article content main post entry story".split())

#: Groups that a host's distinct skeletons are dealt over before they are aligned.
PARTS = 64
#: Pages that must have one and the same text at a place before it counts as the template's.
SAME_PAGES = 4

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-zA-Z]+")
_SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("path", "text", "at")

    def __init__(self, path: tuple[str, ...], text: str, at: int):
        self.path, self.text, self.at = path, text, at


@lru_cache(maxsize=10_000)
def beside(path: tuple[str, ...]) -> bool:
    """Whether a container path lies in a part beside the article."""
    inside = False
    for name in path:
        tag, *words = name.split(".")
        if tag in LEFT_OUT or (tag == "header" and not inside) or (
                tag not in ("body", "html", "main") and not BESIDE.isdisjoint(words)):
            return True
        inside = inside or tag == "article"
    return False


def read(page: str) -> tuple[list[Block], list[str]]:
    """Text blocks, each with its container path and its token's number, and the page's tokens."""
    blocks: list[Block] = []
    tokens: list[str] = []
    stack: list[tuple[str, str]] = []  # tag, name in paths
    text: list[str] = []

    def flush() -> None:
        if text:
            whole = _SPACE.sub(" ", "".join(text)).strip()
            text.clear()
            if whole:
                blocks.append(Block(tuple(s[1] for s in stack), whole, len(tokens)))
                tokens.append("#")

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            text.append(html.unescape(page[at:stop]))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if m[1]:
            if tag not in BLOCK and tag not in LEFT_OUT:
                continue
            flush()
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
                tokens.append(f"</{tag}>")
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag not in BLOCK and tag not in LEFT_OUT:
            continue
        flush()
        if tag == "body":
            stack = [s for s in stack if s[0] != "head"]
        if tag not in CONTAINER and tag not in LEFT_OUT:
            tokens.append(f"<{tag}>")
            continue
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
            stack.pop()
        words = {w.lower() for _, a, b, c in _ATTRIBUTE.findall(m[3]) for w in _WORD.findall(a or b or c)}
        name = tag + "".join(f".{w}" for w in sorted(words))
        tokens.append(f"<{name}>")
        if not m[3].rstrip().endswith("/"):
            stack.append((tag, name))
    flush()
    return blocks, tokens


def folded(tokens: list[str], longest: int = 12) -> tuple[list[str], list[tuple[int, int]]]:
    """Adjacent equal runs of tokens as one group ``(...)+``, and each token's folded token and number in its group."""
    out: list[str] = []
    sizes: list[int] = []
    numbers: list[list[int]] = []

    def numbered(begin: int, end: int) -> list[int]:
        found, before = [], 0
        for size, inner in zip(sizes[begin:end], numbers[begin:end]):
            found += [before + k for k in inner]
            before += size
        return found

    for token in tokens:
        out.append(token)
        sizes.append(1)
        numbers.append([0])
        again = True
        while again:
            again, have, last = False, len(out), out[-1]
            for n in range(1, min(longest, have - 1) + 1):
                before = out[-n - 1]
                if before != last and not before.startswith("("):
                    continue
                group = out[-n:]
                repeated = f"({' '.join(group)})+"
                if before == repeated:
                    numbers[-n - 1] += numbered(have - n, have)
                    del out[-n:], sizes[-n:], numbers[-n:]
                    again = True
                    break
                if out[-2 * n:-n] == group:
                    both = numbered(have - 2 * n, have - n) + numbered(have - n, have)
                    size = sum(sizes[-n:])
                    out[-2 * n:], sizes[-2 * n:], numbers[-2 * n:] = [repeated], [size], [both]
                    again = True
                    break
    return out, [(i, k) for i, inner in enumerate(numbers) for k in inner]


def aligned(wrapper: list[tuple[str, bool]], page: list[str | tuple[str, bool]]) -> list[tuple[str, bool]]:
    """The wrapper (tokens, and whether each is optional) that also fits the page (plain tokens) or other wrapper."""
    other = [(t, False) if isinstance(t, str) else t for t in page]
    out: list[tuple[str, bool]] = []
    matcher = SequenceMatcher(None, [t for t, _ in wrapper], [t for t, _ in other], autojunk=False)
    for op, a, b, c, d in matcher.get_opcodes():
        if op == "equal":
            out += [(t, x or y) for (t, x), (_, y) in zip(wrapper[a:b], other[c:d])]
        else:
            out += [(t, True) for t, _ in wrapper[a:b] + other[c:d]]
    # an optional group beside its own repetition is part of it
    kept: list[tuple[str, bool]] = []
    for token, optional in out:
        if kept and optional and kept[-1][0] in (f"({token})+", token):
            continue
        kept.append((token, optional))
    return kept


def written(wrapper: list[tuple[str, bool]]) -> str:
    return " ".join(f"({t})?" if optional else t for t, optional in wrapper)


def main_container(text: dict[tuple[str, ...], int]) -> tuple[str, ...]:
    """Path of the container that holds the article, from the amounts of text directly in each path."""
    under: Counter = Counter()
    for path, n in text.items():
        for k in range(len(path) + 1):
            under[path[:k]] += n
    total = under[()]
    for wanted in (("article",), ("main",)):
        found = [p for p in under if p and p[-1].split(".")[0] in wanted
                 and not any(q.split(".")[0] in wanted for q in p[:-1])]
        if found:
            return max(found, key=lambda p: (under[p], p))
    named = [p for p in under if p and p[-1].split(".")[0] not in ("body", "html") and set(p[-1].split(".")[1:]) & MAIN_WORDS
             and 2 * under[p] >= total]
    if named:
        return min(named, key=lambda p: (len(p), -under[p], p))
    return max((p for p in under if 10 * under[p] >= 6 * total), key=lambda p: (len(p), p), default=())


@lru_cache(maxsize=256)
def _places(wrapper: str) -> tuple[dict[str, list[int]], list[int]]:
    """Where a wrapper has each token, and how many tokens that are not optional come before each place."""
    where: dict[str, list[int]] = defaultdict(list)
    must = [0]
    for j, (token, optional) in enumerate(_tokens(wrapper)):
        where[token].append(j)
        if token.startswith("("):
            where[token[1:-2]].append(j)
        must.append(must[-1] + (not optional))
    return where, must


@lru_cache(maxsize=4_096)
def matched(skeleton: str, wrapper: str) -> list[int]:
    """The wrapper's place of each token of a folded skeleton.

    A run of the expression over the tokens; if it doesn't accept them, each token's first place after the one before
    it, and -1 without one.
    """
    where, must = _places(wrapper)
    tokens = [t for t, _ in _tokens(skeleton)]
    reached, steps = [-1], []
    for token in tokens:
        step = {}
        for j in where.get(token, ()):
            k = bisect_left(reached, j) - 1
            if k >= 0 and must[j] == must[reached[k] + 1]:
                step[j] = reached[k]
        steps.append(step)
        reached = list(step)
    at = next((j for j in reversed(reached) if must[-1] == must[j + 1]), None)
    if at is not None:
        found = []
        for step in reversed(steps):
            found.append(at)
            at = step[at]
        return found[::-1]
    found, at = [], -1
    for token in tokens:
        places = where.get(token, [])
        k = bisect_right(places, at)
        found.append(places[k] if k < len(places) else -1)
        at = max(at, found[-1])
    return found


def chosen(places: dict[tuple[int, int, tuple[str, ...]], tuple[int, bool]]) -> tuple[tuple[str, ...], set, set]:
    """Main container, places to take, and places that the slot's own container decides.

    `places` has each (place, number in its group, container): amount of text and whether it is the template's.
    """
    text: Counter = Counter()
    all_text: Counter = Counter()
    for (_, _, path), (n, same) in places.items():
        if not beside(path):
            all_text[path] += n
            if not same:
                text[path] += n
    main = main_container(text or all_text)
    marked = not text or any(name.split(".")[0] in ("article", "main") for name in main)
    verdicts: dict[tuple[int, int], set[bool]] = defaultdict(set)
    for (place, number, path), (_, same) in places.items():
        verdicts[place, number].add(path[:len(main)] == main and not beside(path) and (marked or not same))
    return main, {p for p, v in verdicts.items() if v == {True}}, {p for p, v in verdicts.items() if len(v) == 2}


def article(page: str, wrapper: str, main: tuple[str, ...], take: frozenset, differing: frozenset) -> str:
    """The text of a page's slots at places to take."""
    blocks, tokens = read(page)
    out, numbers = folded(tokens)
    at = matched(" ".join(out), wrapper)

    def taken(b: Block) -> bool:
        token, number = numbers[b.at]
        place = (at[token], number)
        return place in take or ((place in differing or at[token] < 0) and b.path[:len(main)] == main and not beside(b.path))

    texts = [b.text for b in blocks if taken(b)]
    if not texts:
        blocks = [b for b in blocks if not beside(b.path)]
        if not any(b.path[:len(main)] == main for b in blocks):
            own: Counter = Counter()
            for b in blocks:
                own[b.path] += len(b.text)
            main = main_container(own)
            texts = [b.text for b in blocks if b.path[:len(main)] == main]
    return "\n".join(texts)


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _path(what: str) -> tuple[str, ...]:
    return tuple(what.split("/")) if what else ()


def _with_host(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce(col(url_col).cast("string"), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).cast("string").alias("html"),
                        host.alias("host"))


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, pages, wrapper, main, take, differing): each host's regular expression, main container and places."""
    figures = ("n", "chars", "low", "high", "page_low", "page_high")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, list[int]] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks, tokens = read(page or "")
                out, numbers = folded(tokens)
                skeleton = " ".join(out)
                key = blake2b(skeleton.encode(), digest_size=16).hexdigest()
                whole = _hash("\0".join(b.text for b in blocks))
                of_page: dict[tuple, list[int]] = {(host, key, -1, 0, skeleton): [1, 0, 0, 0, whole, whole]}
                for b in blocks:
                    slot, h, n = (host, key, *numbers[b.at], "/".join(b.path)), _hash(b.text), len(b.text)
                    old = of_page.get(slot)
                    of_page[slot] = [1, n + old[1], min(h, old[2]), max(h, old[3]), whole, whole] if old else [1, n, h, h, whole, whole]
                for slot, new in of_page.items():
                    old = seen.get(slot)
                    seen[slot] = [old[0] + 1, old[1] + new[1], min(old[2], new[2]), max(old[3], new[3]),
                                  min(old[4], whole), max(old[5], whole)] if old else new
            keys, values = list(seen), list(seen.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()))]
                + [pa.array([v[i] for v in values], pa.int64()) for i in range(6)], ["host", "key", "token", "number", "what", *figures])

    def merge(group: pa.Table) -> pa.Table:
        """The common wrapper of the skeletons or wrappers of a group; pages without tokens have no part in it."""
        rows = sorted(zip(group.column("n").to_pylist(), group.column("what").to_pylist()), key=lambda r: (-r[0], r[1]))
        return pa.table({"host": group.column("host").slice(0, 1), "n": pa.array([sum(n for n, _ in rows)], pa.int64()),
                         "what": pa.array([written(reduce(aligned, [_tokens(what) for _, what in rows if what] or [[]]))],
                                          pa.string())})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, tokens, places = [], [], [], []
            for host, key, skeleton, wrapper in zip(*(c.to_pylist() for c in batch.columns)):
                at = matched(skeleton, wrapper)
                hosts += [host] * len(at)
                keys += [key] * len(at)
                tokens += range(len(at))
                places += at
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.string()), pa.array(tokens, pa.int32()),
                                              pa.array(places, pa.int32())], ["host", "key", "token", "place"])

    def choose(group: pa.Table) -> pa.Table:
        places = {(p, k, _path(what)): (chars, same) for p, k, what, chars, same in zip(
            *(group.column(c).to_pylist() for c in ("place", "number", "what", "chars", "same")))}
        main, take, differing = chosen(places)
        return pa.table({"host": group.column("host").slice(0, 1), "main": pa.array(["/".join(main)], pa.string())} | {
            c: pa.array([[f"{p}.{k}" for p, k in sorted(found)]], pa.list_(pa.string())) for c, found in (("take", take), ("differing", differing))})

    seen = rows.select("host", "html").mapInArrow(describe, "host string, key string, token int, number int, what string, "
                                                  + ", ".join(f"{c} long" for c in figures))
    seen = stored(seen.groupBy("host", "key", "token", "number", "what").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("page_low").alias("page_low"), F.max("page_high").alias("page_high")))
    skeletons = seen.where("token < 0").select("host", "key", "what", "n")
    # a hot host's skeletons are dealt over PARTS groups, so the last step aligns at most PARTS wrappers a host
    whole = (skeletons.withColumn("part", F.pmod(F.xxhash64("what"), F.lit(PARTS))).groupBy("host", "part")
             .applyInArrow(merge, "host string, n long, what string")
             .groupBy("host").applyInArrow(merge, "host string, n long, what string"))
    whole = stored(whole.select("host", F.col("n").alias("pages"), F.col("what").alias("wrapper")))
    at = (skeletons.join(whole, "host").select("host", "key", "what", "wrapper")
          .mapInArrow(place, "host string, key string, token int, place int"))
    places = (seen.where("token >= 0").join(at, ["host", "key", "token"]).groupBy("host", "place", "number", "what").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("page_low").alias("page_low"), F.max("page_high").alias("page_high")))
    same = (F.col("n") >= SAME_PAGES) & (F.col("low") == F.col("high")) & (F.col("page_low") < F.col("page_high"))
    places = (places.select("host", "place", "number", "what", "chars", same.alias("same")).groupBy("host")
              .applyInArrow(choose, "host string, main string, take array<string>, differing array<string>"))
    return whole.join(places, "host", "left")


def _tokens(skeleton: str) -> list[tuple[str, bool]]:
    """Top-level tokens of a folded skeleton or written wrapper, and whether each is optional."""
    out, depth, begin = [], 0, 0
    for i, sign in enumerate(skeleton + " "):
        if sign == "(":
            depth += 1
        elif sign == ")":
            depth -= 1
        elif sign == " " and not depth:
            if i > begin:
                token = skeleton[begin:i]
                out.append((token[1:-2], True) if token.endswith(")?") else (token, False))
            begin = i + 1
    return out


@lru_cache(maxsize=256)
def _numbers(places: str | None) -> frozenset[tuple[int, ...]]:
    return frozenset(tuple(map(int, p.split("."))) for p in (places or "").split())


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    bound_batches(pages.sparkSession)
    rows = _with_host(pages, id_col, url_col, html_col)
    hosts = stored(wrappers(rows)).select("host", "wrapper", "main", F.array_join("take", " ").alias("take"),
                                          F.array_join("differing", " ").alias("differing"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [article(page or "", wrapper or "", _path(main), _numbers(take), _numbers(differing))
                     for page, wrapper, main, take, differing in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    ids, urls = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    return rows.join(hosts, "host", "left").select("page_id", "url", "html", "wrapper", "main", "take", "differing").mapInArrow(
        extract, f"page_id {ids}, url {urls}, text string, n_chars long")
