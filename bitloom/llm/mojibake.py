"""Text that was decoded with the wrong encoding: finding it and restoring the original."""

from __future__ import annotations

import codecs
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Encodings a text may have been read in by mistake, the likeliest first (fixed values).
READ_AS = ["cp1252", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp1250", "cp1253", "cp1254", "cp1257", "iso8859_2", "iso8859_15", "cp866", "cp852", "gbk", "cp932", "cp949", "big5"]

#: Encodings it may have been written in, in (fixed values).
WRITTEN_AS = ["utf-8", "cp1252", "cp850", "cp437", "mac_roman", "cp1250", "cp1254", "cp1251", "koi8_r", "cp866", "cp852", "cp1253", "cp1257", "iso8859_2", "gb18030", "cp932", "euc_jp", "cp949", "big5", "koi8_u"]

#: Those of them in which a byte is a sign (fixed values).
_ONE_BYTE = {"cp1252", "cp850", "cp437", "mac_roman", "cp1250", "cp1254", "cp1251", "koi8_r", "cp866", "cp852", "cp1253", "cp1257", "iso8859_2", "koi8_u"}

#: An encoding that differs from the first one in few signs only, and these signs, which may come from either (fixed values).
_NEAR, _NEAR_SIGNS = "iso8859_15", "€ŠšŽžŒœŸ"

#: Size of the table of letter pairs, and groups of repositories that are counted apart; 4 bytes for each of both, whatever the corpus.
PAIRS, GROUPS = 1 << 20, 16

_HAN, _DRAWING = 5, 7
_REMEMBERED, _SHORT = 200_000, 40  # words a worker remembers, and how long one may be

_TABLED = 1 << 18  # letter pairs up to which a worker keeps their bits for each group of repositories (8 bytes each)

_HOPELESS = 8  # impossible signs in a line by which it counts as garbled even without a repair
_FOREIGN = 0.6  # share of the bits of a pair seen nowhere that pairs of a line must cost on average to be taken for read wrongly more than once
_ENOUGH = 12  # letter pairs by which that can be told
_ROUNDS = 3  # wrong readings between one-byte encodings that are undone (those of UTF-8 are as many as there are)
_ODD = 10.0  # bits that an impossible sign costs
_RARE = 5.5  # bits a letter pair may cost on average before other readings are tried
_MIN_DROP = 7.0  # bits by which a reading must be cheaper, and the share it must save of what the changed pairs cost
_MIN_SHARE, _LAYERED_SHARE = 0.3, 0.6

_RUN = re.compile(r"[^\x00-\x7f]+")
_RUNS = re.compile(r"[^\x00-\x7f]{2}")
_WORD = re.compile(r"[A-Za-z]*[^\x00-\x7f](?:[A-Za-z]|[^\x00-\x7f])*")
_MULTIBYTE = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}")
_LITERAL = re.compile(r"""(["'`])([^\x00-\x7f]+)\1""")
_PLAIN = re.compile(r"[\t\n\r -~]")
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
_PLAIN_RUN = re.compile(r"[\t\n\r -~]{8,}")
#: Signs of UTF-16 read as one-byte text of which one byte is zero.
_WIDE = {"utf-16-le": re.compile(r"(?:[\t\n\r -~\xa0-\xff]\x00){4,}"), "utf-16-be": re.compile(r"(?:\x00[\t\n\r -~\xa0-\xff]){4,}")}
_QUOTED = re.compile(r"""(["'`])([^"'`\n]+)\1""")

#: Letters of languages written in Latin script and signs of ordinary typography, besides whole blocks below (fixed values).
_LATIN = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿĀāĂăĄąĆćČčĎďĐđĒēĖėĘęĚěĞğĢģĪīĮįİıĶķĹĺĻļĽľŁłŃńŅņŇňŌōŐőŒœŔŕŘřŚśŞşŠšŢţŤťŪūŮůŰűŲųŸŹźŻżŽžȘșȚțƠơƯư"
_SIGNS = " ¡¢£¤¥¦§¨©ª«¬­®¯°±²³´µ¶·¸¹º»¼½¾¿×÷ˆ˜–—‘’‚“”„†‡•…‰‹›€™№←↑→↓⇒⇐∀∂∃∅∆∇∈∏∑−√∞∩∪∫≈≠≤≥﻿ﬁﬂ"
_BLOCKS = [(0x386, 0x3CF), (0x400, 0x45F), (0x490, 0x491), (0x5D0, 0x5EA), (0x60C, 0x60C), (0x61F, 0x61F), (0x621, 0x652), (0x660, 0x669), (0x67E, 0x6D2), (0x904, 0x96F), (0xE01, 0xE5B), (0x1EA0, 0x1EF9), (0x2070, 0x209C), (0x2100, 0x214F), (0x2460, 0x2473), (0x2500, 0x25FF), (0x2600, 0x27BF), (0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFE0F, 0xFE0F), (0xFF01, 0xFF9F), (0x1F300, 0x1FAFF)]

#: Signs that may stand between letters of a word (fixed values).
_INNER = set("’‘'-·–—…→×±•­")


@cache
def _classes() -> np.ndarray:
    """Of each character: 0 a control or unassigned, 8 a letter that is hardly ever the right reading, 1 a sign, 2 Latin, 3 Cyrillic, 4 Greek, 5 Han or kana, 6 Hangul and further scripts, 7 drawing."""
    kinds = np.fromiter((8 if unicodedata.category(chr(c))[0] in "LMN" else 0 for c in range(0x110000)), np.uint8, 0x110000)
    kinds[:128] = 1
    for low, high in _BLOCKS:
        kinds[low : high + 1] = 1
    for c in _SIGNS:
        kinds[ord(c)] = 1
    for c in _LATIN:
        kinds[ord(c)] = 2
    kinds[65:91] = kinds[97:123] = kinds[0x1EA0:0x1EFA] = 2
    kinds[0x400:0x460] = kinds[0x490:0x492] = 3
    kinds[0x386:0x3D0] = 4
    kinds[0x387] = 1
    kinds[0x3041:0x3100] = kinds[0x3005:0x3008] = kinds[0x4E00:0xA000] = 5
    kinds[0x30FB] = 1
    kinds[0xFF66:0xFFA0] = 8  # half-width kana come from wrong readings
    for low, high in ((0x5D0, 0x5EB), (0x621, 0x653), (0x67E, 0x6D3), (0x904, 0x950), (0xE01, 0xE5C), (0xAC00, 0xD7A4)):
        kinds[low:high] = 6
    kinds[0x2500:0x25A0] = 7
    return kinds


def _table(name: str) -> dict[int, int] | None:
    """Bytes of the characters of a one-byte encoding; bytes it leaves open stand for themselves, as lenient readers take them."""
    try:
        sign = {b: bytes([b]).decode(name, "ignore") for b in range(256)}
    except LookupError:
        return None
    if not all(len(c) <= 1 for c in sign.values()) or codecs.lookup(name).name in ("gbk", "cp932", "cp949", "big5"):
        return None
    table = {ord(c): b for b, c in sign.items() if c}
    for b in range(128, 256):
        if b < 160 or not sign[b]:
            table.setdefault(b, b)
    return table


def _pairs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places in the pair table, and the line of each, of all neighbouring characters of which one at least isn't ASCII.

    ASCII letters lose their case, other ASCII signs become one.
    """
    c = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    low = c < 128
    small = c | 32
    plain = np.where(low, np.where((small >= 97) & (small <= 122), small, 32), c)
    at = np.flatnonzero(~(low[:-1] & low[1:]))
    a, b = plain[at], plain[at + 1]
    return (a * 0x9E3779B1 + b * 0x85EBCA77 + (a ^ b)) % 0x7FFFFFFF % PAIRS, np.cumsum(c == 10)[at]


def pair_codes(text: str) -> np.ndarray:
    """Places in the pair table of the letter pairs of ``text``."""
    return _pairs(text)[0]


def _words(text: str) -> str:
    """The words of ``text`` with anything beyond ASCII; they have all its letter pairs and odd signs, and stay few on long lines."""
    return " ".join(_WORD.findall(text))


class Mender:
    """Judges and repairs texts, given in how many different documents each letter pair occurs.

    ``seen`` has a row for each group of repositories, and a last one for documents of no
    repository or with copies in several groups; ``slot`` has the column of each letter pair, and ``documents`` how many each row counts.
    """

    def __init__(self, slot: np.ndarray, seen: np.ndarray, documents: np.ndarray):
        self.slot, self.seen, self.documents = slot, seen, documents
        self.everywhere = seen.sum(0)
        # the two groups of repositories in which each pair occurs most
        self.first, self.second = np.argsort(-seen[:-1], 0, kind="stable")[:2]
        self.group, self.text, self.copied = None, "", None
        self.kinds = _classes()
        self.likely = (self.kinds > 0) & (self.kinds < 8)
        self.written = self.likely & (self.kinds != _DRAWING)  # likely, and no drawing
        self.bits: dict[tuple[int | None, bool], np.ndarray] = {}
        self.odd: dict[str, int] = {}
        self.runs: dict[tuple[str, str], str | None] = {}
        self.tables = {n: _table(n) for n in READ_AS}
        self.single = [n for n in READ_AS if self.tables[n]]
        # a byte order mark as it looks after one, two or three wrong readings
        self.marks = tuple(sorted((m for n in self.single for m in self._marks(n)), key=len, reverse=True))
        # three signs in a row that may be a UTF-8 sequence of three bytes
        self.wide = {}
        for name in ("cp1252", "mac_roman", "cp1251", "koi8_r"):
            signs = lambda low, high: "".join(re.escape(chr(c)) for c, b in self.tables[name].items() if low <= b <= high)  # noqa: E731, B023
            self.wide[name] = re.compile(f"[{signs(0xE0, 0xEF)}][{signs(0x80, 0xBF)}]{{2}}")

    def _marks(self, name: str) -> list[str]:
        sign = {b: chr(c) for c, b in self.tables[name].items()}
        mark, marks = "\ufeff", []
        for _ in range(3):
            mark = "".join(sign.get(b, "\ufffd") for b in mark.encode())
            marks.append(mark)
        return marks

    # -- cost -------------------------------------------------------------

    def about(self, text: str, group: int) -> None:
        """From now on the lines of ``text`` are judged, by the counts of other repositories where those are the most."""
        apart = group < GROUPS and 2 * self.documents[group] <= self.documents.sum()
        self.group = group if apart else None
        self.text, self.copied = text, None

    def _counts_itself(self) -> bool:
        """Whether the document itself, or a copy of it, may be among those counted."""
        if self.copied is None:
            pairs = self.slot[pair_codes("\n".join(line for line in self.text.split("\n") if not line.isascii()))]
            self.copied = self.group is None or bool(self.seen[-1, pairs].all())
        return self.copied

    def _bits(self, at: np.ndarray, own: bool) -> np.ndarray:
        minus, columns = own and self._counts_itself(), self.slot[at]
        if len(self.everywhere) > _TABLED:
            return self._bits_of(columns, minus)
        key = self.group, minus
        if key not in self.bits:
            self.bits[key] = self._bits_of(np.arange(len(self.everywhere)), minus)
        return self.bits[key][columns]

    def _bits_of(self, columns: np.ndarray, minus: bool) -> np.ndarray:
        n, documents, first = self.everywhere[columns], self.documents.sum(), self.first[columns]
        most = documents / 2
        if self.group is not None:
            n, documents = n - self.seen[self.group, columns], documents - self.documents[self.group]
            first = np.where(first == self.group, self.second[columns], first)
        # nor does one group alone make a pair normal
        rest = documents - self.documents[first]
        n, documents = np.where(rest >= most, n - self.seen[first, columns], n), np.where(rest >= most, rest, documents)
        if minus:
            n = np.maximum(n - 1, 0)
        return np.log2((np.maximum(documents, 1) + 1.0) / (n + 0.25)).clip(0)

    def suspects(self, lines: list[str]) -> tuple[list[str], list[str]]:
        """The lines with impossible signs or mostly rare letter pairs, and those of them with hardly any pair that others have; the document itself, its copies and its repository are left out."""
        at, of = _pairs("\n".join(lines))
        size = np.bincount(of, minlength=len(lines))
        mean = np.bincount(of, self._bits(at, True), len(lines)) / np.maximum(size, 1)
        least = max(_RARE, _FOREIGN * np.log2(4.0 * (self.documents.sum() + 1)))
        chosen = [(line, m >= least and n >= _ENOUGH) for line, m, n in zip(lines, mean, size) if m >= _RARE or self.oddity(line)]
        return [line for line, _ in chosen], [line for line, foreign in chosen if foreign]

    def oddity(self, text: str) -> int:
        """Signs of a wrong reading that need no corpus: controls, mixed scripts, signs and capitals inside words, rows of accents."""
        return sum(self._odd_word(w) for w in _WORD.findall(text))

    def _odder(self, text: str, limit: float) -> bool:
        """Whether the oddity of ``text`` is above ``limit``; stops where it is."""
        odd = 0
        for m in _WORD.finditer(text):
            odd += self._odd_word(m.group())
            if odd > limit:
                return True
        return False

    def _odd_word(self, word: str) -> int:
        known = self.odd.get(word)
        if known is None:
            known = self._judge_word(word)
            if len(word) <= _SHORT:
                if len(self.odd) >= _REMEMBERED:
                    self.odd.clear()
                self.odd[word] = known
        return known

    def _judge_word(self, word: str) -> int:
        kinds = self.kinds[np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4")].tolist()
        if set(kinds) == {_HAN}:
            return 0
        odd = kinds.count(0)
        parts, at = [], 0
        for kind, same in groupby(kinds):
            size = len(list(same))
            parts.append((kind, at, size))
            at += size
        for i, (kind, start, size) in enumerate(parts):
            before, after = parts[i - 1][0] if i else 1, parts[i + 1][0] if i + 1 < len(parts) else 1
            if kind in (1, 7) and before in (2, 3, 4) and after in (2, 3, 4):
                odd += sum(c not in _INNER for c in word[start : start + size])
            if kind == 7 and (1 < before < 7 or 1 < after < 7):
                odd += 1
            if i and {kind, before} <= {2, 3, 4}:
                odd += 1
            if kind in (5, 6) and (before == after == 2 or size == 1 and 2 in (before, after)):
                odd += 1  # Latin words beside Han or Hangul are usual; inside a word, or one sign at its end, they are not
        row, last = 0, "A"
        for c, k in zip(word, kinds):
            # a capital after a small letter, one of them accented
            odd += last.islower() and c.isupper() and (last > "\x7f" or c > "\x7f")
            # four accented letters and signs in a row
            row = row + 1 if "\xa0" < c < "\u0250" and k in (1, 2) else 0
            odd += row >= 4
            last = c
        return odd

    def plausible(self, text: str) -> bool:
        return bool(self.likely[[ord(c) for c in set(text)]].all())

    # -- readings -----------------------------------------------------------

    def bytes_of(self, text: str, name: str) -> bytes | None:
        """The bytes that read as ``text`` in the encoding, if there are any."""
        table = self.tables[name]
        try:
            if table is None:
                return text.encode(name)
            return bytes([table[ord(c)] for c in text])
        except (KeyError, UnicodeEncodeError):
            return None

    def _utf8(self, run: str, first: str = READ_AS[0]) -> str | None:
        """A run of signs beyond ASCII read as the UTF-8 it was, through as many layers as there are (each makes it shorter)."""
        best, now = None, run
        while True:
            for name in self.single if first == READ_AS[0] else (first, *self.single):
                raw = self.bytes_of(now, name)
                if raw is None:
                    continue
                try:
                    read = raw.decode("utf-8")
                except UnicodeDecodeError:
                    continue
                if len(read) < len(now):
                    now = read
                    break
            else:
                break
            if self.plausible(now):
                best = now
        return best

    def _mended_run(self, run: str, first: str) -> str:
        if (run, first) not in self.runs:
            if len(self.runs) >= _REMEMBERED:
                self.runs.clear()
            new = self._utf8(run, first)
            if len(run) > _SHORT:
                return new or run
            self.runs[run, first] = new
        return self.runs[run, first] or run

    def _mended_runs(self, line: str, first: str = READ_AS[0]) -> str:
        """``line`` with each run of signs read as UTF-8 where it can be, out of the encoding ``first`` if that is possible."""
        return _RUN.sub(lambda m: self._mended_run(m.group(), first), line) if _RUNS.search(line) else line

    def _mended_line(self, line: str) -> str:
        """As :meth:`_mended_runs`, if the line gets cheaper by it: a few letters of correct text may pass for UTF-8 too."""
        new = self._mended_runs(line)
        if new == line:
            return line
        if any(c in _NEAR_SIGNS for c in line) and (other := self._mended_runs(line, _NEAR)) != new and self._cost(other) < self._cost(new):
            new = other
        odd = self.oddity(line)
        return new if self.oddity(new) <= odd and self._drop(line, new, odd, 0.0) > 0 else line

    def _cost(self, text: str) -> float:
        return float(self._bits(pair_codes(text), False).sum()) + _ODD * self.oddity(text)

    def _remains(self, line: str) -> bool:
        """Whether there is UTF-8 in wrong reading left of which signs were lost."""
        for name, pattern in self.wide.items():
            if not pattern.search(line):
                continue
            table = self.tables[name]
            whole = [m for m in _MULTIBYTE.findall(bytes(table.get(ord(c), 0x3F) for c in line)) if len(m) > 2 and self.plausible(m.decode())]
            if len(whole) > 1:
                return True
        return False

    def _drop(self, text: str, read: str, odd: int, share: float = _MIN_SHARE, codes: np.ndarray | None = None) -> float:
        """Bits that ``read`` costs less than ``text`` (of which ``codes`` are the letter pairs), over what differs between them; 0 if that is too small a share."""
        a, b = pair_codes(text) if codes is None else codes, pair_codes(read)
        at, which = np.unique(np.concatenate([a, b]), return_inverse=True)
        extra = np.bincount(which[: len(a)], minlength=len(at)) - np.bincount(which[len(a) :], minlength=len(at))
        lost, new = extra > 0, extra < 0
        was = float(self._bits(at[lost], True) @ extra[lost]) + _ODD * odd
        now = float(self._bits(at[new], False) @ -extra[new]) + _ODD * self.oddity(read)
        return was - now if was - now >= share * was else 0.0

    def _readings(self, text: str) -> list[str]:
        """What ``text`` is in any other pair of encodings."""
        out = {}
        for name in READ_AS:
            raw = self.bytes_of(text, name)
            if raw is None:
                continue
            for other in WRITTEN_AS:
                try:
                    read = raw.decode(other)
                except UnicodeDecodeError:
                    continue
                if read != text:
                    out[read] = None
        return list(out)

    def _written_readings(self, text: str, signs: str) -> list[str]:
        """The readings of ``text`` all signs of which are letters or usual signs; ``signs`` are its different ones beyond ASCII.

        Between one-byte encodings they tell that, before the whole text is read.
        """
        out, tried = {}, {signs}
        for name in READ_AS:
            some = self.bytes_of(signs, name)
            raw = None
            for other in WRITTEN_AS if some is not None else ():
                try:
                    if name in self.single and other in _ONE_BYTE:
                        few = some.decode(other)
                        if few not in tried:
                            tried.add(few)
                            if self.written[[ord(c) for c in few]].all():
                                raw = raw or self.bytes_of(text, name)
                                out[raw.decode(other)] = None
                        continue
                    raw = raw or self.bytes_of(text, name)
                    read = raw.decode(other)
                except UnicodeDecodeError:
                    continue
                if read != text and read not in out and self.written[[ord(c) for c in set(read)]].all():
                    out[read] = None
        return list(out)

    def _legacy(self, text: str) -> str | None:
        """The reading of ``text`` in another pair of encodings by which its cost drops most, if it drops enough."""
        signs = "".join(sorted({c for c in text if c > "\x7f"}))
        if not signs:
            return None
        odd = self.oddity(text)
        if not odd:
            beyond = self.kinds[[ord(c) for c in text if c > "\x7f"]]
            if 2 * (beyond == _DRAWING).sum() > len(beyond):
                return None  # a drawing
        best, most, codes = None, _MIN_DROP, pair_codes(text)
        for read in self._written_readings(text, signs):
            if self._odder(read, odd / 4):
                continue
            drop = self._drop(text, read, odd, codes=codes)
            if drop > most:
                best, most = read, drop
        return best

    def _layered(self, text: str) -> str | None:
        """As :meth:`_legacy` for text in one-byte encodings that was read wrongly more than once: rounds of readings, until one is cheap enough.

        A round changes single signs, so it is found by what becomes of the different signs of
        ``text``; only readings in which all of them are letters or usual signs are weighed. With
        more rounds there are more readings to be cheap by chance, so each must save more, most of the cost, and must not be suspect itself.
        """
        odd, signs = self.oddity(text), "".join(sorted({c for c in text if c > "\x7f"}))
        words = _words(text)
        codes, seen, now = pair_codes(words), {signs}, {signs: None}
        for round_ in range(1, _ROUNDS + 1):
            best, most, following = None, round_ * _MIN_DROP, {}
            for state in now:
                for read in self._readings(state):
                    if read in seen or len(read) != len(signs) or len(set(read)) != len(signs):
                        continue
                    seen.add(read)
                    following[read] = None
                    if round_ == 1 or not self.written[[ord(c) for c in read]].all():
                        continue
                    changed = dict(zip(map(ord, signs), read))
                    read_words = words.translate(changed)
                    if self._odder(read_words, odd / 4) or self._bits(pair_codes(read_words), False).mean() >= _RARE:
                        continue
                    drop = self._drop(words, read_words, odd, _LAYERED_SHARE, codes)
                    if drop > most:
                        best, most = changed, drop
            if best is not None:
                return text.translate(best)
            now = following
        return None

    def _utf16(self, text: str, name: str) -> str | None:
        """``text`` read in UTF-16, if it can be and all its signs are likely."""
        raw = self.bytes_of(text, "cp1252")
        try:
            read = None if raw is None else raw.decode(name)
        except UnicodeDecodeError:
            return None
        return read if read is not None and self.plausible(read) else None

    def _between(self, gap: str, name: str) -> bool:
        """Whether what lies between two stretches of UTF-16 is UTF-16 too, and no plain text."""
        plain = len(_PLAIN.findall(gap))
        if len(gap) % 2 or plain > 0.8 * len(gap) and "\n" in gap:
            return False
        return self._utf16(gap, name) is not None

    def _mended_wide(self, text: str, name: str) -> tuple[str, int]:
        """``text`` with its stretches of UTF-16 read as such and the rest as it is, and how many of their ends are ends of lines."""
        spans: list[list[int]] = []
        for m in _WIDE[name].finditer(text):
            if spans and self._between(text[spans[-1][1] : m.start()], name):
                spans[-1][1] = m.end()
            else:
                spans.append([m.start(), m.end()])

        def wide(pair: str) -> bool:
            return len(pair) == 2 and len(_PLAIN.findall(pair)) < 2 and self._utf16(pair, name) is not None

        parts, last, whole = [], 0, 0
        for k, (start, end) in enumerate(spans):
            stop = spans[k + 1][0] if k + 1 < len(spans) else len(text)
            while start - 2 >= last and wide(text[start - 2 : start]):
                start -= 2
            while end + 2 <= stop and wide(text[end : end + 2]):
                end += 2
            read = self._utf16(text[start:end], name) or text[start:end]
            whole += (not start or text[start - 1] == "\n") + (end == len(text) or read.endswith("\n"))
            parts += [text[last:start], read]
            last = end
        return "".join([*parts, text[last:]]), whole

    def _mended_utf16(self, text: str) -> str:
        """``text`` with all UTF-16 in it read as such, or as it is."""
        for name, zeros, others in (("utf-16-le", text[1::2], text[::2]), ("utf-16-be", text[::2], text[1::2])):
            # of the whole text: one byte of each pair is zero wherever the sign was ASCII
            if len(text) % 2 == 0 and zeros.count("\x00") > max(0.1 * len(zeros), 4 * others.count("\x00")):
                raw = self.bytes_of(text, "cp1252")
                try:
                    read = "" if raw is None else raw.decode(name)
                except UnicodeDecodeError:
                    continue
                # bytes of Han and kana may look like plain text, but not for long
                plain = max((len(r) for r in _PLAIN_RUN.findall(text)), default=0)
                if read and plain < 24 and self.likely[[ord(c) for c in read]].mean() >= (1 if plain else 0.9):
                    return read
        ways = []
        for first, second in (("utf-16-le", "utf-16-be"), ("utf-16-be", "utf-16-le")):
            read, whole = self._mended_wide(text, first)
            read, more = self._mended_wide(read, second)
            ways.append((len(_CONTROL.findall(read)), -whole - more, self.oddity(read), read))
        return min(ways, key=lambda w: w[:3])[3]  # in plain letters both byte orders read alike

    # -- texts --------------------------------------------------------------

    def _meant(self, line: str) -> str:
        """``line`` without garbled literals that a program quotes on purpose: U+FFFD by itself, or what stands beside its own repair."""
        if not _LITERAL.search(line):
            return line
        quoted = {q for _, q in _QUOTED.findall(line)}

        def keep(m: re.Match) -> str:
            inner = m.group(2)
            if set(inner) <= {"�"}:
                return '""'
            if len(quoted) > 1:
                fixed = self._utf8(inner)
                if fixed and fixed in quoted:
                    return '""'
                # signs that don't show may be lost from it
                if not fixed and any(len(q) == 1 and q > "\x7f" and q != inner for q in quoted):
                    return '""'
            return m.group()

        return _LITERAL.sub(keep, line)

    def mend(self, text: str) -> tuple[bool, str | None]:
        """Whether a passage of ``text`` was read wrongly, and the text restored (None where signs are lost)."""
        found, lost = False, False
        if "\x00" in text:
            read = self._mended_utf16(text)
            if read != text:
                found, lost, text = True, "\x00" in read, read
        lines = text.split("\n")
        open_: dict[str, list[int]] = {}
        for i, line in enumerate(lines):
            if line.isascii() or not line.strip():
                continue
            if line.startswith(self.marks):  # of the file, or of one that was put after a line of its own
                found = True
                lines[i] = line = "\ufeff" + line[next(len(m) for m in self.marks if line.startswith(m)) :]
            bare = self._meant(line)
            if bare != line:
                # what a program quotes on purpose stays as it is
                if "�" in bare or self._mended_line(bare) != bare:
                    found = lost = True
                continue
            if "�" in line:
                found = lost = True
            mended = self._mended_line(line)
            if mended != line:
                found = True
                lines[i] = line = mended
            if "�" not in line and not line.isascii():
                open_.setdefault(line, []).append(i)
        suspects, foreign = self.suspects(list(open_)) if open_ else ([], [])
        if suspects:
            # one document is mostly read wrongly in one way: its lines are judged together, then one by one
            read = self._legacy("\n".join(suspects))
            if read is not None and read.count("\n") == len(suspects) - 1:
                fixed = read.split("\n")
            else:
                fixed = [self._legacy(line) or line for line in suspects]
                still = [line for line, new in zip(suspects, fixed) if new == line and line in foreign]
                if still and (read := self._layered("\n".join(still))):
                    more = dict(zip(still, read.split("\n")))
                    fixed = [more.get(line, new) for line, new in zip(suspects, fixed)]
            for line, new in zip(suspects, fixed):
                if new != line:
                    found = True
                    for i in open_[line]:
                        lines[i] = new
                elif self._remains(line) or self.oddity(line) >= _HOPELESS:
                    found = lost = True
        return found, None if lost or not found else "\n".join(lines)


def _strange(docs: DataFrame) -> DataFrame:
    """Documents with anything beyond ASCII, or NUL."""
    return docs.filter(F.col("text").rlike(r"[^\x01-\x7f]"))


def _beyond_ascii() -> Column:
    """The different lines of a text with anything beyond ASCII, in order: all that its letter pairs come from."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x00-\x7f]"))
    return F.array_join(F.array_sort(F.array_distinct(lines)), "\n")


def _group(docs: DataFrame) -> Column:
    """The group of a document's repository; GROUPS for one without a repository, which stands for itself."""
    if "repo" not in docs.columns:
        return F.lit(GROUPS)
    return F.when(F.col("repo").isNull(), GROUPS).otherwise(F.pmod(F.xxhash64("repo"), F.lit(GROUPS)).cast("int"))


def pair_counts(docs: DataFrame) -> DataFrame:
    """``pair, n``: in how many different documents each letter pair (by its place in the table) occurs; pair -1 counts the documents.

    ``n`` has a number for each group of repositories, and a last one for documents of no repository or with copies in several of them.
    Documents with the same lines beyond ASCII are copies and count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, documents = {}, {}
        for batch in batches:
            for text, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if group not in seen:
                    seen[group], documents[group] = np.zeros(PAIRS, np.int32), 0
                seen[group][np.unique(pair_codes(text))] += 1
                documents[group] += 1
        for group, counts in seen.items():
            at = np.flatnonzero(counts)
            groups = np.full(len(at) + 1, group, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(groups), pa.array(np.r_[documents[group], counts[at]].astype(np.int64))], ["pair", "group", "n"])

    copies = _strange(docs).select(_beyond_ascii().alias("lines"), _group(docs).alias("group")).filter("lines != ''").groupBy("lines").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    once = copies.select("lines", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(GROUPS).alias("group"))
    numbers = F.array(*(F.sum(F.when(F.col("group") == g, F.col("n")).otherwise(0)) for g in range(GROUPS + 1)))
    return once.mapInArrow(run, "pair bigint, group int, n bigint").groupBy("pair").agg(numbers.alias("n"))


def mended_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every document of which a passage was read in another encoding than it was written in, repaired.

    Needs ``doc_id, text``; ``repo`` is used where there is one, other columns are dropped. ``text`` is null where
    signs of the original are lost. A document with null, empty or plain ASCII text
    is no case. Repeated rows give one row per ``doc_id`` (null ids one).

    Round trip: text is encoded as it may have been read and strictly decoded as
    it may have been written, layer by layer, and the reading is taken where a garbling cost
    drops. The cost adds up signs that no language writes and the rarity of
    letter pairs, counted over the different texts of all documents into a table of bounded size (4 MB,
    and 68 bytes a letter pair that occurs; the one thing broadcast). Copies of a text count once, and a
    document is judged without its copies, its repository and the repositories in which a pair occurs most,
    so a garbling that is common does not pass for normal. Only a group of repositories with most of all texts judges itself.
    """
    spark = docs.sparkSession
    counts = pair_counts(docs).toArrow()  # at most PAIRS rows
    pair = counts.column("pair").to_numpy()
    n = counts.column("n").combine_chunks().flatten().to_numpy().reshape(len(pair), GROUPS + 1)
    slot, documents = np.zeros(PAIRS, np.int32), n[pair < 0].sum(0)
    slot[pair[pair >= 0]] = np.arange(1, (pair >= 0).sum() + 1)
    seen = np.concatenate([np.zeros((1, GROUPS + 1), np.int64), n[pair >= 0]]).clip(0, 2**31 - 1).astype(np.int32)
    shared = spark.sparkContext.broadcast((slot, np.ascontiguousarray(seen.T), documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mender = Mender(*shared.value)
        for batch in batches:
            ids, texts = [], []
            for key, text, group in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                mender.about(text, group)
                found, mended = mender.mend(text)
                if found:
                    ids.append(key.as_py())
                    texts.append(mended)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(texts, pa.string())], ["doc_id", "text"])

    used = _strange(docs).select("doc_id", "text", _group(docs).alias("group"))
    cases = used.mapInArrow(run, f"doc_id {used.dtypes[0][1]}, text string")
    return cases.groupBy("doc_id").agg(F.max("text").alias("text"))
