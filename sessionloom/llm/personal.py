"""Personal information in free text: found, and replaced by typed placeholders.

Information-theoretic sanitisation. Addresses, phones, identity numbers, mailboxes
and accounts are read by their formats. For names, a pass over the whole corpus
counts in which contexts each capitalised term stands. A context discloses persons
as far as many different terms of the name list stand in it; a term discloses a
person as far as its occurrences stand in such contexts. Both scores feed each
other for some rounds; terms and occurrences above the disclosure threshold are
names, so names the list doesn't know are found and listed words that are mostly
ordinary ones are left where their context says nothing.
"""

from __future__ import annotations

import functools
import itertools
import re
from bisect import bisect_left

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.spans import Spans
from sessionloom.session import shared_dir, written

#: Disclosure above which a term or a place is a name's; weight of the assumption that a context discloses nothing.
DISCLOSED, DOUBT, ROUNDS = 0.5, 3.0, 4
#: Share of a term's occurrences in disclosing contexts from which it is a name by itself, wherever it stands.
ALONE = 0.9

# Local parts of mailboxes that belong to a role, a machine or everyone.
ROLES = frozenset(
    "noreply no-reply donotreply do-not-reply support info admin administrator root postmaster webmaster hostmaster security abuse sales help helpdesk contact team git svn hg build ci bot bots jenkins github gitlab hello office mail news newsletter notifications alerts ops devops dev billing accounts hr jobs press privacy legal user users test tester demo example sample you me name someone user1 foo bar service services system daemon deploy app www www-data api marketing feedback all everyone staff".split()
)
# Accounts of machines, images and services, and shared profiles.
MACHINES = frozenset(
    "runner ubuntu node root shared public app git jenkins vagrant ec2-user circleci travis docker build builder deploy www-data admin administrator user users default guest test tester ci centos debian fedora pi postgres mysql redis nginx nobody daemon bin sys www ftp svc service agent runneradmin coder vscode codespace gitpod jovyan airflow hadoop spark hdfs kafka elastic azureuser cloud-user core opc staff wheel work workspace src home data all username you me name project projects".split()
)
_SERVICE = re.compile(r"^(?:svc|srv|sys|app|bot|ci|user|tester|test|demo|sample|dev|build)[-_.]?\w*\d*$|.*(?:-bot|_bot|-ci|_svc|-svc|\[bot\])$", re.I)

_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])")
_AT = r"\s*(?:\[at\]|\(at\)|\{at\}|<at>|＠|\s+at\s+|\s@\s)\s*"
_DOT = r"\s*(?:\[dot\]|\(dot\)|\{dot\}|<dot>|\s+dot\s+|\.)\s*"
_HIDDEN = re.compile(rf"(?<![\w.+-])(?P<u>[A-Za-z0-9][\w+-]*(?:\.[\w+-]+)*){_AT}(?P<h>[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*?{_DOT}[A-Za-z]{{2,}})(?![\w-])", re.I)

_PHONE = re.compile(
    r"(?<![\w.+/-])(?:"
    r"\+\d{1,3}(?:[ .-]?(?:\(\d{1,5}\)|\d{1,5})){1,5}"
    r"|00\d{2}[ -]\d{1,4}[ -]\d{4,9}(?:[ -]\d{1,4})?|00[1-9]\d{9,12}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3}-\d{3}-\d{4}|\d{3} \d{3}-\d{4}"
    r"|0\d(?:[ .]\d{2}){4}|0\d{2,4}/\d{3,8}(?:-\d{1,5})?|0\d{2,4} \d{3,4} \d{3,4}|0\d{3,4}-\d{6,7}"
    r"|1[3-9]\d-\d{4}-\d{4}|\(\d{2}\) 9?\d{4}-\d{4}"
    r")(?![\w]|[-./]\d)"
)
_NO_PHONE = re.compile(r"(?:order|isbn|sku|article|art|build|version|ver|v|rev|issue|ticket|invoice|epoch|port|ports|serial|part|ref|no|#|lines?)[. :#-]*(?:no\.?|number|nr\.?)?[ :#]*$", re.I)

_LABEL = re.compile(
    r"(?<![A-Za-z0-9+/])(?:(?:SSN|social security(?: number| no\.?)?)\W{0,3}(?P<a>\d{3}[ -]?\d{2}[ -]?\d{4})"
    r"|(?:Steuer-?ID(?:entifikationsnummer)?|Steuernummer|IdNr\.?|TIN|tax (?:id|number|no\.?))\W{0,4}(?P<b>\d{2,3}(?:[ /-]?\d{2,4}){2,4})"
    r"|(?:passport|Reisepass|pasaporte|passeport|passaporte|护照|паспорт|パスポート)(?:[ -]?(?:no|nr|number|号码?|n[º°])\.?)?\W{0,3}(?P<c>[A-Z]{0,2}\d[\d ]{5,11}\d)"
    r"|(?:DNI|NIE|NIF)\W{0,3}(?P<d>[XYZ]?\d{7,8}-?[A-Z])"
    r"|(?:NINO?|national insurance(?: number| no\.?)?)\W{0,3}(?P<e>[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D])"
    r"|(?:身份证(?:号码?)?|居民身份证)\W{0,3}(?P<f>\d{17}[\dXx]|\d{15})"
    r"|(?:CPF|ИНН|СНИЛС|codice fiscale|n[º°] de sécurité sociale|INSEE|BSN|PESEL|マイナンバー|주민등록번호)\W{0,4}(?P<g>[A-Z0-9][\w. /-]{7,20}\w))(?!\w)",
    re.I,
)
_BARE_ID = re.compile(
    r"(?<![\w.+-])(?:(?P<ssn>\d{3}-\d{2}-\d{4})|(?P<dni>\d{8}-?[A-HJ-NP-TV-Z])|(?P<nie>[XYZ]\d{7}-?[A-HJ-NP-TV-Z])|(?P<nino>[A-CEGHJ-PQR-TW-Z][A-CEGHJ-NPQR-TW-Z] ?\d{2} ?\d{2} ?\d{2} ?[A-D])"
    r"|(?P<cn>\d{6}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dX])|(?P<cpf>\d{3}\.\d{3}\.\d{3}-\d{2})|(?P<cf>[A-Z]{6}\d{2}[A-EHLMPRST]\d{2}[A-Z]\d{3}[A-Z]))(?![\w]|[-.]\w)"
)

_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ]"
_ADDRESS = re.compile(
    r"(?<![\w-])(?:"
    rf"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite) \d+[A-Za-z]?, ?)?\d{{1,5}}[a-z]? (?:{_CAP}[\w'’-]+ ){{1,3}}(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Court|Ct|Close|Boulevard|Blvd|Drive|Dr|Way|Place|Pl|Terrace|Square|Crescent|Hill|Row|Mews|Parkway)\b\.?"
    rf"|{_CAP}[\wäöüß-]*(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|ring)\s\d{{1,4}} ?[a-z]?\b"
    rf"|{_CAP}[\wäöüß-]+[ -](?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ufer|Ring)\s\d{{1,4}} ?[a-z]?\b"
    rf"|\d{{1,4}}(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|bd|place|chemin|impasse|quai|allée|cours|route) (?:(?:de la|des|de|du|d'|la|le|les|l') ?)?{_CAP}[\w'’-]+"
    rf"|(?:Calle|C/|Avenida|Avda\.|Av\.|Plaza|Paseo|Rua|Travessa|Praça|Via|Viale|Piazza) ?(?:(?:de la|de los|del|de|da|do|dos|das) )?{_CAP}[\w'’-]+(?: [\w'’-]+){{0,3}}?,? (?:n[º°.] ?)?\d{{1,4}}\b"
    rf"|(?:ул\.|улица|пр\.|проспект|пер\.|наб\.) ?{_CAP}[\w-]+,? (?:д\. ?)?\d{{1,4}}"
    r")"
    r"|[一-鿿]{2}(?:市|县|区)(?:[一-鿿]{1,6}区)?[一-鿿]{1,8}(?:路|街|道|巷|大道)\d{1,5}号"
    r"|[一-鿿]{2,3}[都道府県](?:[一-鿿]{1,6}[市区町村])?[一-鿿ぁ-ヿ]{1,8}\d{1,3}(?:丁目|-)\d{1,3}"
)

# Words one of which every address holds, in lower case: those that end a word, those a number
# follows, those that follow a number, and those that need nothing.
STREETS = (
    ("ends", [f" {w}" for w in "street st road rd lane ln avenue ave court ct close boulevard blvd drive dr way place pl terrace square crescent hill row mews parkway".split()]),
    ("number", "straße strasse str. weg gasse platz allee ufer ring".split()),
    ("behind", [f" {w} " for w in "rue avenue boulevard bd place chemin impasse quai allée cours route".split()]),
    ("", "calle c/ avenida avda. av. plaza paseo rua travessa praça via viale piazza ул. улица пр. проспект пер. наб.".split() + list("市县区都道府県")),
)
_DIGIT, _DIGITS, _TWO_DIGITS = re.compile(r"\d"), re.compile(r"\d+"), re.compile(r"\d[ .)/-]?\d")


@functools.lru_cache(maxsize=1)
def _streets():
    a = ahocorasick.Automaton()
    marks: dict[str, tuple[str, ...]] = {}
    for kind, words in STREETS:
        for w in words:
            marks[w] = (*marks.get(w, ()), kind)
    for w, kinds in marks.items():
        a.add_word(w, (len(w), kinds))
    a.make_automaton()
    return a


def _may_hold_address(low: str) -> bool:
    """Whether a street's word stands where an address has one."""
    for end, (size, kinds) in _streets().iter(low):
        after, begin = low[end + 1 : end + 3], end - size
        if "" in kinds or ("ends" in kinds and not after[:1].isalnum()) or ("number" in kinds and after[:1].isspace() and after[1:].isdigit()):
            return True
        if "behind" in kinds and begin >= 0 and (low[begin].isdigit() or low[begin] in ",sr"):
            return True
    return False


_USER = r"[A-Za-z0-9_][A-Za-z0-9_.-]*"
_LOGIN = (
    re.compile(r"(?<![A-Za-z])[A-Za-z]:(?:/|\\+)(?:Users|Documents and Settings)(?:/|\\+)(?P<u>[^\\/:*?\"<>|\n]*[^\W_][^\\/:*?\"<>|\n]*? [^\\/:*?\"<>|\n]+)(?=[\\/])", re.I),
    re.compile(rf"(?:/(?:var/)?home/|/Users/|/mnt/[a-z]/Users/|(?<![A-Za-z])[A-Za-z]:(?:/|\\+)(?:Users|Documents and Settings)(?:/|\\+)|\\home\\|/export/home/|(?<![\w/])~)(?P<u>{_USER})", re.I),
    re.compile(rf"(?<![A-Za-z0-9])-(?:home|Users)-(?P<u>[A-Za-z0-9_.]+)(?=-|$|/)"),
    re.compile(rf"(?<![A-Za-z0-9])(?:[A-Za-z]--|[A-Za-z]-)Users-(?P<u>[A-Za-z0-9_.]+)(?=-|$|/)"),
    re.compile(rf"(?<![\w-])[-dlbcps][r-][w-][xsS-][r-][w-][xsS-][r-][w-][xtT-][.+@]?\s+(?:\d+\s+)?(?P<u>{_USER})\s"),
    re.compile(rf"\bchown\s+(?:-\w+\s+|--\w[\w=-]*\s+)*(?P<u>{_USER})(?::{_USER})?\s"),
    re.compile(rf"\b(?:sudo|runuser)\s+(?:-\w+\s+)*?-u\s+(?P<u>{_USER})|\bsu\s+(?:-l?\s+)(?P<v>{_USER})|\b(?:useradd|usermod|userdel|passwd|adduser|deluser)\s+(?:-\w+(?:\s+[\w,/]+)?\s+)*(?P<w>{_USER})\s*$", re.M),
    re.compile(rf"\b(?:owner|uid|user)=\d+\((?P<u>{_USER})\)"),
)

_LABELS = ("ssn", "social", "steuer", "idnr", "tin", "tax", "pass", "pasaporte", "护照", "паспорт", "パスポート", "dni", "nie", "nif", "nin", "insurance", "身份证", "cpf", "инн", "снилс", "fiscale", "sécurité", "insee", "bsn", "pesel", "マイ", "주민")
_LOGIN_MARKS = (("users", "documents and"), ("home", "users", "documents and", "~"), ("-home-", "-users-"), ("-users-",), ("rwx", "rws", "rw-", "r-x", "r-s", "r--", "-wx", "-ws", "-w-", "--x", "--s", "---"), ("chown",), ("sudo", "runuser", "su ", "su\t", "su\n", "useradd", "usermod", "userdel", "passwd", "adduser", "deluser"), ("uid=", "user=", "owner="))

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|[^\w\s]|\n")
_SHORTENED = re.compile(r"^[A-Za-z]{1,6}['’](?:m|s|d|ll|ve|re|t)$", re.I)
_TITLES = frozenset("mr mrs ms miss dr prof herr frau m mme mlle sr sra srta sir madam señor señora don doña г-н г-жа".split())


def _formats(text: str) -> list[tuple[int, int, str]]:
    """Finds of all kinds but person, and ('other') the mailboxes and machine accounts in which no name counts."""
    out: list[tuple[int, int, str]] = []
    spans = Spans()

    def take(s: int, e: int, kind: str) -> None:
        if spans.take(s, e):
            out.append((s, e, kind))

    low = text.lower()
    numbered = _TWO_DIGITS.search(text) is not None
    if "@" in low or "at" in low or "＠" in low:
        for m in _EMAIL.finditer(text) if "@" in text else ():
            local = m[0].split("@")[0].lower()
            before = text[max(0, m.start() - 1) : m.start()]
            userinfo = before in ("/", ":") and re.search(r"://[^\s/]*$", text[max(0, m.start() - 200) : m.start()])
            repo = text[m.end() : m.end() + 1] == ":" and re.match(r":[\w~][\w./-]*\.git|:[\w-]+/", text[m.end() : m.end() + 80])
            plain = local.split("+")[0]
            take(m.start(), m.end(), "other" if plain in ROLES or _SERVICE.match(plain) or userinfo or repo else "email")
        for m in _HIDDEN.finditer(text) if any(w in low for w in ("[at]", "(at)", "{at}", "<at>", "＠", " @ ")) or (" dot " in low and " at " in low) else ():
            gap = text[m.end("u") : m.start("h")]
            spoken = gap.strip().lower() == "at"
            if spoken and not re.search(r"\bdot\b", m["h"], re.I):
                continue
            local = m["u"].lower().split("+")[0]
            take(m.start(), m.end(), "other" if local in ROLES or _SERVICE.match(local) else "email")
    for m in _ADDRESS.finditer(text) if _DIGIT.search(text) and (len(low) != len(text) or _may_hold_address(low)) else ():
        take(m.start(), m.end(), "address")
    for m in _LABEL.finditer(text) if any(w in low for w in _LABELS) else ():
        take(*m.span(m.lastgroup), "idnum")
    for m in _BARE_ID.finditer(text) if numbered else ():
        v, before = re.sub("[ -]", "", m[0]), text[max(0, m.start() - 16) : m.start()]
        if m.lastgroup in ("dni", "nie"):
            n = int(str("XYZ".find(v[0])) + v[1:8]) if m.lastgroup == "nie" else int(v[:8])
            if "TRWAGMYFPDXBNJZSQVHLCKE"[n % 23] != v[-1] and not re.search(r"id\W{0,3}$", before, re.I):
                continue
        if m.lastgroup in ("ssn", "cpf") and _NO_PHONE.search(before):
            continue
        take(m.start(), m.end(), "idnum")
    for m in _PHONE.finditer(text) if numbered else ():
        digits = sum(c.isdigit() for c in m[0])
        if not 8 <= digits <= 15 or _NO_PHONE.search(text[max(0, m.start() - 16) : m.start()]):
            continue
        take(m.start(), m.end(), "phone")
    for marks, p in zip(_LOGIN_MARKS, _LOGIN):
        for m in p.finditer(text) if any(w in low for w in marks) else ():
            group = next((g for g in ("u", "v", "w") if m.groupdict().get(g) is not None), None)
            s, e = m.span(group)
            name = text[s:e].rstrip(".")
            e = s + len(name)
            if name.lower() in MACHINES or _SERVICE.match(name) or not re.search("[A-Za-z]", name):
                take(s, e, "other")
            else:
                take(s, e, "login")
    return out


def _upper(w: str) -> bool:
    return w[0].isupper() and not (len(w) > 1 and w.isupper())


def runs(text: str, blocked: list[tuple[int, int, str]]):
    """Runs of adjacent capitalised words: a list of (start, end, word, context, place in the run).

    Words inside finds, paths, code names and mailboxes are no candidates. A context is
    what stands before and after the run; it never holds a name itself.
    """
    taken = sorted(blocked)
    begins = [x[0] for x in taken]
    toks = [(*m.span(), m[0]) for m in _TOKEN.finditer(text)]
    spans = [False] * len(toks)
    for i, (s, e, w) in enumerate(toks):
        if not w[0].isupper() or len(w) < 2 or w.isupper() or (not w.isalpha() and _SHORTENED.search(w)):
            continue
        at = bisect_left(begins, e)
        if at and taken[at - 1][1] > s:
            continue
        before, after = text[s - 1] if s else "", text[e] if e < len(text) else ""
        if before and (before in "_/\\.@#$" or before.isdigit()) and not (before == "." and s > 1 and text[s - 2].isupper()):
            continue
        if after and (after in "_/\\@(" or after.isdigit() or (after == "." and e + 1 < len(text) and text[e + 1].isalpha())):
            continue
        spans[i] = True
    heads = [k for k, is_word in enumerate(spans) if is_word]
    done = 0
    for i in heads:
        if i < done:
            continue
        j = i
        while j + 1 < len(toks):
            gap = text[toks[j][1] : toks[j + 1][0]]
            if spans[j + 1] and gap == " ":
                j += 1
            elif j + 2 < len(toks) and spans[j + 2] and toks[j + 1][2] == "-" and gap == "" and toks[j + 2][0] == toks[j + 1][1]:
                j += 2
            elif j + 3 < len(toks) and spans[j + 3] and len(toks[j + 1][2]) == 1 and toks[j + 1][2].isupper() and gap == " " and toks[j + 2][2] == "." and text[toks[j + 2][1] : toks[j + 3][0]] == " ":
                j += 3
            elif j + 2 < len(toks) and spans[j + 2] and toks[j + 1][2] == "," and gap == "" and text[toks[j + 1][1] : toks[j + 2][0]] == " ":
                j += 2
            else:
                break
        words = [k for k in range(i, j + 1) if spans[k]]
        left = toks[i - 1][2].lower() if i else "^"
        if left == "." and i > 1:
            left = toks[i - 2][2].lower() + "."
        right = toks[j + 1][2].lower() if j + 1 < len(toks) else "$"
        left, right = (x if x.isalpha() else _DIGITS.sub("9", x) for x in (left, right))
        out = []
        for n, k in enumerate(words):
            # a run's first word has what is before it, its last what is after it; inner ones their neighbours' kind
            place = "only" if len(words) == 1 else "first" if n == 0 else "last" if n == len(words) - 1 else "mid"
            out.append((toks[k][0], toks[k][1], toks[k][2], f"{left if n == 0 else '*'}|{place}|{right if n == len(words) - 1 else '*'}|{left if n else ''}|{right if n < len(words) - 1 else ''}"))
        yield out
        done = j + 1


def term(w: str) -> str:
    return re.sub(r"['’]s$", "", w).lower()


_SCANNED = "b_start array<int>, b_end array<int>, b_kind array<string>, r_no array<int>, r_start array<int>, r_end array<int>, r_term array<string>, r_ctx array<string>"
_LISTS = (*[pa.list_(pa.int32())] * 2, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 3, *[pa.list_(pa.string())] * 2)


def _scanned(text: str | None) -> tuple[list, ...]:
    """Formats (start, end, kind) and words of runs (run, start, end, term, context) of a text, as lists."""
    blocked = _formats(text) if text else []
    words = [(n, s, e, term(w), c) for n, r in enumerate(runs(text, blocked)) for s, e, w, c in r] if text else []
    return *(map(list, zip(*blocked)) if blocked else ([],) * 3), *(map(list, zip(*words)) if words else ([],) * 5)


def scan(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, the text, and what its one reading gave: formats and candidates with their contexts."""
    spec = "".join(f"`{k}` {t}, " for k, t in rows.select(*keys).dtypes)
    names = [x.split()[0] for x in _SCANNED.split(", ")]

    def run(batches):
        for batch in batches:
            done = list(zip(*map(_scanned, batch.column(len(keys)).to_pylist()))) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, t in zip(done, _LISTS)]], names=[*keys, text, *names])

    return rows.select(*keys, text).mapInArrow(run, f"{spec}`{text}` string, {_SCANNED}")


def context_counts(scanned: DataFrame) -> DataFrame:
    """(term, context, n) over the whole corpus, by partial aggregates."""
    each = scanned.select(F.inline(F.arrays_zip(F.col("r_term").alias("term"), F.col("r_ctx").alias("context"))))
    return each.groupBy("term", "context").agg(F.count("*").alias("n"))


def disclosure(counts: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, score, listed, kind) and (context, score).

    A context's score is the mean disclosure of the different terms that stand in it,
    with DOUBT terms that disclose nothing added: a word that stands alone in its
    context proves nothing about it. A term's score is the mean over its different
    contexts, with as much doubt; listed terms keep at least a quarter.
    """
    listed = names.where("name is not null").select(F.lower(F.trim("name")).alias("term"), "name_kind").groupBy("term").agg(F.min("name_kind").alias("kind"))
    counts = written(counts, "contexts")
    terms = counts.select("term").distinct().join(listed, "term", "left").withColumn("score", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0))
    contexts = None
    for _ in range(ROUNDS):
        terms = written(terms, "terms")
        contexts = counts.join(terms, "term").groupBy("context").agg((F.sum("score") / (F.count("*") + DOUBT)).alias("context_score"))
        scored = counts.join(contexts, "context").groupBy("term").agg((F.sum("context_score") / (F.count("*") + DOUBT)).alias("mean"))
        terms = terms.select("term", "kind").join(scored, "term").select("term", "kind", F.when(F.col("kind").isNotNull(), F.greatest("mean", F.lit(0.25)) + 0.25).otherwise(F.col("mean") * 1.3).alias("score"))
        terms = terms.withColumn("score", F.least("score", F.lit(1.0)))
    terms = terms.unionByName(listed.join(counts.select("term").distinct(), "term", "left_anti").withColumn("score", F.lit(0.5)).select("term", "kind", "score"))
    shares = counts.join(contexts, "context", "left").groupBy("term").agg((F.sum(F.when(F.col("context_score") >= DISCLOSED, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    terms = terms.join(shares, "term", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    return terms.select("term", "kind", "score", "share"), contexts.select("context", F.col("context_score").alias("score"))


class Lexicon:
    """What discloses a person: terms (score, listed, alone) and contexts above the threshold."""

    def __init__(self, terms: dict[str, tuple[float, bool, bool]], contexts: dict[str, float]):
        self.terms, self.contexts = terms, contexts


class Stored:
    """A lexicon as sorted hashes: 13 bytes a term and 12 a context, so ten million names take 130 MB of a
    worker. A batch of texts asks for all its words at once and gets a small :class:`Lexicon`."""

    def __init__(self, folder: str):
        t, c = _table(f"{folder}/terms"), _table(f"{folder}/contexts")
        self.terms = self._sorted(t, np.float32, "score") + self._sorted(t, np.uint8, "marks")[1:]
        self.contexts = self._sorted(c, np.float32, "score")

    @staticmethod
    def _sorted(table: pa.Table, kind, value: str) -> tuple[np.ndarray, np.ndarray]:
        hashes = table["hash"].to_numpy()
        order = np.argsort(hashes, kind="stable")
        return hashes[order], table[value].to_numpy()[order].astype(kind)

    @staticmethod
    def _places(hashes: np.ndarray, words: list[str]):
        """(word, place) of those that are there."""
        if not len(hashes) or not words:
            return
        asked = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words)).view(np.int64)
        at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
        for i in np.flatnonzero(hashes[at] == asked).tolist():
            yield words[i], at[i]

    def of(self, terms: set[str], contexts: set[str]) -> Lexicon:
        hashes, score, marks = self.terms
        known = {w: (float(score[i]), bool(marks[i] & 1), bool(marks[i] & 2)) for w, i in self._places(hashes, list(terms))}
        return Lexicon(known, {c: float(self.contexts[1][i]) for c, i in self._places(self.contexts[0], list(contexts))})


@functools.lru_cache(maxsize=4)
def _read_lexicon(folder: str) -> Stored:
    """Loaded once per worker from the shared folder; nothing passes through the driver."""
    return Stored(folder)


def _table(uri: str) -> pa.Table:
    if "://" not in uri and not uri.startswith("file:"):
        return pads.dataset(uri, format="parquet").to_table()
    if uri.startswith("file:"):
        return pads.dataset("/" + uri[5:].lstrip("/"), format="parquet").to_table()
    fs, path = pafs.FileSystem.from_uri(uri)
    return pads.dataset(path, filesystem=fs, format="parquet").to_table()


def find(text: str | None, lexicon: Lexicon) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each piece of personal information, in order, without overlaps.

    Null and empty texts give an empty list. Positions count code points.
    """
    return _judged(text, *_scanned(text), set(_WORD.findall(text)), lexicon) if text else []


def _judged(text: str, b_start: list, b_end: list, b_kind: list, r_no: list, r_start: list, r_end: list, r_term: list, r_ctx: list, words: set[str], lexicon: Lexicon) -> list[tuple[int, int, str]]:
    """What of a scanned text is personal, by the lexicon."""
    blocked, spans = list(zip(b_start, b_end, b_kind)), Spans()
    for s, e, _ in blocked:
        spans.take(s, e)
    out = [x for x in blocked if x[2] != "other"]
    terms, contexts = lexicon.terms, lexicon.contexts
    for _, group in itertools.groupby(zip(r_no, r_start, r_end, r_term, r_ctx), lambda x: x[0]):
        r = list(group)
        if not any(x[3] in terms or x[4] in contexts for x in r):
            continue
        hits = []
        for _, s, e, w, c in r:
            t, listed, alone = terms.get(w, (0.0, False, False))
            here = contexts.get(c, 0.0)
            title = _title_before(text, s)
            sure = t >= 0.7 or (t >= DISCLOSED and here >= DISCLOSED) or (title and (t >= 0.25 or here >= DISCLOSED)) or (t >= DISCLOSED and _with_initial(text, s) < s)
            hits.append((s, e, w, t, here, bool(sure), listed, title or alone or here >= DISCLOSED))
        n = len(hits)
        mark = [h[5] for h in hits]
        # a listed or likely word beside a sure one is part of the name
        for k in range(n):
            if not mark[k] and (hits[k][6] or hits[k][3] >= DISCLOSED):
                near = [q for q in (k - 1, k + 1) if 0 <= q < n]
                if any(mark[q] or (hits[q][3] >= DISCLOSED or hits[q][6]) for q in near):
                    mark[k] = True
        k = 0
        while k < n:
            if not mark[k]:
                k += 1
                continue
            last = k
            commas = 0
            while last + 1 < n and mark[last + 1]:
                gap = text[hits[last][1] : hits[last + 1][0]]
                if gap == ", ":
                    if commas or last > k or (last + 2 < n and mark[last + 2] and text[hits[last + 1][1] : hits[last + 2][0]] == " " and not _short(hits[last + 2][2])):
                        break
                    commas += 1
                last += 1
            s, e = hits[k][0], hits[last][1]
            s = _with_initial(text, s)
            if k == last and s == hits[k][0] and not hits[k][7]:
                k = last + 1
                continue
            if spans.free(s, e):
                out.append((s, e, "person"))
            k = last + 1
    kept = Spans()
    for s, e, _ in out:
        kept.take(s, e)
    for s, e in _lower_pairs(text, lexicon, words):
        if kept.free(s, e):
            out.append((s, e, "person"))
    return sorted(out)


def _short(w: str) -> bool:
    return len(w) == 1


def _title_before(text: str, s: int) -> bool:
    m = re.search(r"([^\W\d_]+)\.? $", text[max(0, s - 12) : s])
    return bool(m) and m[1].lower() in _TITLES


def _with_initial(text: str, s: int) -> int:
    m = re.search(rf"(?<![\w.])((?:{_CAP}\. ?){{1,2}})$", text[max(0, s - 8) : s])
    return s - len(m[1]) if m and text[s - 1 : s] in " ." else s


_LOWER = re.compile(r"(?<![\w@./\\-])[^\W\d_]{3,}(?:-[^\W\d_]{3,})?(?![\w@/\\]|\.\w)")


_WORD = re.compile(r"[^\W\d_]{3,}")


def _is_name(known: tuple[float, bool, bool] | None) -> bool:
    return known is not None and (known[0] >= 0.7 or (known[1] and known[0] >= 0.4))


def _lower_pairs(text: str, lexicon: Lexicon, words: set[str]):
    """Two neighbouring lower-case words that are both names; ``words`` are all words of the text."""
    if not any(w.islower() and _is_name(lexicon.terms.get(w)) for w in words & lexicon.terms.keys()):
        return
    prev = None
    for m in _LOWER.finditer(text):
        if not (m[0].islower() and _is_name(lexicon.terms.get(m[0].split("-")[0]))):
            prev = None
        elif prev is not None and text[prev.end() : m.start()] == " ":
            yield prev.start(), m.end()
            prev = None
        else:
            prev = m


PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "idnum": "[ID_NUMBER]", "address": "[ADDRESS]", "person": "[PERSON]", "login": "[LOGIN]"}


def sanitise(text: str | None, lexicon: Lexicon) -> str | None:
    """The text with a typed placeholder in each place; everything else is unchanged."""
    return _replaced(text, find(text, lexicon))


def _replaced(text: str | None, finds: list[tuple[int, int, str]]) -> str | None:
    out, last = [], 0
    for s, e, kind in finds:
        out += [text[last:s], PLACEHOLDERS[kind]]
        last = e
    return text if not out else "".join(out) + text[last:]


def texts(records: DataFrame) -> DataFrame:
    """(id, msg_no, text): every content, and metadata.cwd as msg_no -1."""
    said = records.select("id", F.posexplode("messages").alias("msg_no", "m")).select("id", "msg_no", F.col("m.content").alias("text"))
    at = records.select("id", F.lit(-1).alias("msg_no"), F.col("metadata.cwd").alias("text"))
    return said.unionByName(at).where("text is not null and text <> ''")


def lexicon_folder(rows: DataFrame, names: DataFrame) -> str:
    """Learns the disclosure of terms and contexts from all rows (texts, or what :func:`scan` gave) and writes it to the shared folder."""
    import uuid

    scanned = rows if "r_term" in rows.columns else scan(rows, [])
    terms, contexts = disclosure(context_counts(scanned), names)
    folder = f"{shared_dir(rows.sparkSession)}/lexicon-{uuid.uuid4().hex}"
    marks = F.col("kind").isNotNull().cast("int") + 2 * (F.col("share") >= ALONE).cast("int")
    terms.where("score >= 0.25 or kind is not null").select(F.xxhash64("term").alias("hash"), F.col("score").cast("float").alias("score"), marks.alias("marks")).write.parquet(f"{folder}/terms")
    contexts.where(F.col("score") >= 0.3).select(F.xxhash64("context").alias("hash"), F.col("score").cast("float").alias("score")).write.parquet(f"{folder}/contexts")
    return folder


def _judge(batch: pa.RecordBatch, at: int, stored: Stored) -> list[tuple[str | None, list[tuple[int, int, str]]]]:
    """Each text of a scanned batch and its finds; the batch's words are looked up at once."""
    texts, *lists = (batch.column(i).to_pylist() for i in range(at, at + 9))
    words = [set(_WORD.findall(t)) if t else set() for t in texts]
    lexicon = stored.of(set(itertools.chain.from_iterable(lists[6])).union(*words), set(itertools.chain.from_iterable(lists[7])))
    return [(t, _judged(t, *row, lexicon) if t else []) for t, *row in zip(texts, *lists, words)]


def find_in(rows: DataFrame, keys: list[str], folder: str, text: str = "text") -> DataFrame:
    """keys + (start_at, end_at, kind), one row per occurrence. ``rows`` are texts, or what :func:`scan` gave of them."""
    spec = ", ".join(f"`{k}` {t}" for k, t in rows.select(*keys).dtypes)
    scanned = rows if "r_term" in rows.columns else scan(rows, keys, text)

    def run(batches):
        stored = _read_lexicon(folder)
        for batch in batches:
            at, starts, ends, kinds = [], [], [], []
            for i, (_, finds) in enumerate(_judge(batch, len(keys), stored)):
                for s, e, k in finds:
                    at.append(i), starts.append(s), ends.append(e), kinds.append(k)
            rows_ = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[c.take(rows_) for c in batch.columns[: len(keys)]], pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(kinds, pa.string())], names=[*keys, "start_at", "end_at", "kind"])

    return scanned.mapInArrow(run, f"{spec}, start_at int, end_at int, kind string")


def sanitise_rows(rows: DataFrame, keys: list[str], folder: str, text: str = "text") -> DataFrame:
    """keys + the text with placeholders. ``rows`` as for :func:`find_in`."""
    spec = ", ".join(f"`{k}` {t}" for k, t in rows.select(*keys).dtypes)
    scanned = rows if "r_term" in rows.columns else scan(rows, keys, text)

    def run(batches):
        stored = _read_lexicon(folder)
        for batch in batches:
            clean = pa.array([_replaced(t, finds) for t, finds in _judge(batch, len(keys), stored)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], clean], names=[*keys, text])

    return scanned.mapInArrow(run, f"{spec}, `{text}` string")


def _scanned_records(spark, sf: str) -> tuple[DataFrame, str]:
    """The scanned texts of conversation_records, written, and the lexicon learned from them."""
    records = spark.read.parquet(f"{sf}/conversation_records.parquet").select("id", "messages", "metadata")
    names = spark.read.parquet(f"{sf}/name_list.parquet")
    scanned = written(scan(texts(records), ["id", "msg_no"]), "scanned")
    return scanned, lexicon_folder(scanned, names)


def p4_found(spark, sf: str) -> DataFrame:
    return find_in(*_keyed(*_scanned_records(spark, sf))).select("id", "msg_no", "start_at", "kind").distinct()


def disclosed_bits(terms: DataFrame) -> DataFrame:
    """(term, listed, score, bits) of the terms at or above the threshold: ``bits`` is the pointwise mutual
    information of the term and a person, log2(score / prior), the prior being the listed terms'
    share of all terms of the corpus. A corpus without listed terms gives null bits."""
    prior = terms.agg(F.avg(F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0)).alias("_prior"))
    bits = F.when(F.col("_prior") > 0, F.log2(F.col("score") / F.col("_prior")))
    # one row, joined on a constant
    return terms.where(F.col("score") >= DISCLOSED).withColumn("_one", F.lit(1)).join(prior.withColumn("_one", F.lit(1)), "_one").select("term", F.col("kind").isNotNull().alias("listed"), "score", bits.alias("bits"))


def p4_terms(spark, sf: str) -> DataFrame:
    """What the corpus tells of persons by its terms."""
    records = spark.read.parquet(f"{sf}/conversation_records.parquet").select("id", "messages", "metadata")
    terms, _ = disclosure(context_counts(scan(texts(records), [])), spark.read.parquet(f"{sf}/name_list.parquet"))
    return disclosed_bits(written(terms, "terms"))


def p4_sanitised(spark, sf: str) -> DataFrame:
    """(id, msg_no, text): every content, and every cwd as msg_no -1, with placeholders."""
    return sanitise_rows(*_keyed(*_scanned_records(spark, sf)))


def _keyed(scanned: DataFrame, folder: str) -> tuple[DataFrame, list[str], str]:
    return scanned, ["id", "msg_no"], folder
