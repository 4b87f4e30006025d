"""Problem 4: personal information inside free text.

Method: generators propose overlapping spans with high recall; boosted trees judge each by its format and its context,
one model for each kind; thresholds calibrated on held-out rows choose which spans are replaced by a typed
placeholder.

The models are fitted here on made-up candidates (``SAMPLES``): formats come from numbering plans, check digits and forms
of addresses and names, contexts are drawn word by word from the cue words of ``Lexicon`` and made-up words. No sentence is
written out, so none can be one of the collection. What else tells a name from other words in capitals is unlabelled: whether
the collection (``statistics``), or a public tokenizer's vocabulary, knows a word mostly in lower case.
"""

from __future__ import annotations

import base64
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.boosting import Boosted
from folioscope.runtime import materialize

KINDS = ["email", "phone", "id_number", "address", "name"]
#: Made-up labelled candidates for each kind that the models are fitted on.
SAMPLES = 8_000
#: A word is told about from this share of all words on, so the table has at most 1 / WORD_SHARE rows, and from so many occurrences.
WORD_SHARE, WORD_FROM = 1e-5, 3
#: Folder of a public tokenizer's vocabulary, whose spellings tell which words are mostly written in capitals.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}


def _set(words: str) -> frozenset[str]:
    return frozenset(words.split())


@dataclass(frozen=True)
class Lexicon:
    """Words that features look at; a list of one's own takes the place of any of them."""

    #: forms of address
    titles: frozenset[str] = _set("mr mrs ms miss mx dr doctor prof professor profesor profesora sir dame lord lady herr frau fräulein sr sra srta don doña señor señora m mme mlle monsieur madame mademoiselle signor signora dipl ing rev")
    #: frequent given names of public registers
    given: frozenset[str] = _set(
        "james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica thomas sarah charles karen christopher nancy daniel lisa matthew betty anthony margaret mark sandra steven ashley "
        "paul emily andrew donna george carol kevin amanda edward dorothy brian melissa hans peter klaus wolfgang jürgen günter ursula monika petra sabine renate helga karin ingrid jean pierre michel philippe marie nathalie isabelle sylvie "
        "catherine françoise antonio josé manuel francisco juan maría carmen ana isabel dolores luis carlos miguel lucía pedro mohammed ahmed fatima ali wei priya olga ivan giovanni giulia lars anna"
    )
    #: articles and determiners
    articles: frozenset[str] = _set("the a this that these those our their my your his her its each every no some any der die das den dem des ein eine einen einem einer le la les l un une des du el los las lo una il lo gli mein meine meinen meiner dein deine sein seine ihre unser unsere mon ma mes son sa ses notre votre nos vos mi mis tu tus su sus nuestro nuestra")
    #: other words of a closed class, none of which is part of a name
    function: frozenset[str] = _set(
        "and or but if while when where what which who how why because although since until unless whereas so then thus here there now not also only just very too i we you he she it they me us him them is are was were be been being am do does did has have had "
        "can could will would shall should may might must let und oder aber wenn während weil obwohl damit dass nicht auch nur sehr hier dort jetzt ich wir du er sie es ihr ist sind war waren et ou mais si quand parce ne pas aussi très ici je nous tu il elle ils elles est sont était "
        "y o pero si cuando porque no también muy aquí yo nosotros él ella ellos es son era of to from as von aus an auf de à al see please thanks thank dear hello hi hey yes today tomorrow yesterday heute morgen gestern aujourd hier demain hoy ayer mañana under over before after between during without within through"
    )
    #: prepositions of places
    places: frozenset[str] = _set("in near at into onto outside inside across beyond towards toward above below behind nach hinter über unter zwischen im am bei zum zur dans près vers en cerca hasta desde")
    #: nouns that name a place, a body or a work rather than a person
    bodies: frozenset[str] = _set(
        "street road lane avenue square bridge tower hall house castle inn market station church abbey park garden school university college institute library museum theatre hospital hotel river lake mountain valley forest island bay port city town village county "
        "company corporation inc ltd llc gmbh ag group bank union society association committee department ministry agency press news times post journal review gazette magazine award festival fair cup league club team project system service edition version chapter book song "
        "straße platz weg brücke turm markt haus kirche schloss universität verein gesellschaft zeitung rue place pont église société calle plaza puente iglesia sociedad january february march april june july august september october november december monday tuesday wednesday thursday "
        "friday saturday sunday north south east west new old upper lower great saint world national international"
    )
    #: words by which a person is spoken to or of, and what persons do
    persons: frozenset[str] = _set(
        "according signed sincerely regards greetings yours dear friend colleague neighbour neighbor boss manager teacher doctor patient client customer tenant brother sister mother father cousin aunt uncle wife husband author written by met meet ask asked tell told called named with thank and contact attn "
        "laut selon según herrn frau kollege kollegin freund freundin nachbar nachbarin chef lehrer arzt patientin kundin kunde bruder schwester von an für gezeichnet ami amie collègue voisin voisine patron médecin cliente client frère soeur par pour avec amigo amiga vecino vecina jefe médico hermano hermana por para con"
    )
    acts: frozenset[str] = _set(
        "said says asked asks wrote writes told called calls sent sends thinks thought wants wanted knows knew lives lived works worked agreed replied answered left arrived joined is was has had will and sagte sagt schrieb schreibt fragte meinte rief wohnt arbeitet hat ist war a dit écrit demandé répondu habite travaille est "
        "dijo escribió preguntó llamó vive trabaja es fue"
    )
    phones: frozenset[str] = _set("tel telephone phone mobile cell fax call calls text sms whatsapp ring dial reach number landline voicemail hotline telefon handy mobil rufnummer anrufen erreichbar téléphone portable appelez joindre numéro teléfono móvil celular llame llamar número")
    ids: frozenset[str] = _set(
        "id identity identification ssn social security passport card insurance national nino nir dni nie nif bsn pesel cpr personnummer ahv ausweis personalausweis reisepass pass steuer sozialversicherung identité passeport sécurité sociale carte pasaporte identidad documento seguridad no nr number holder"
    )
    homes: frozenset[str] = _set("address home house live lives lived living moved move send ship shipped deliver delivered delivery mail post parcel visit meet at adresse wohnt wohne wohnhaft liefern lieferung anschrift ziehe besuch habite livrer envoyer domicile dirección vivo vive enviar domicilio flat apartment apt")
    emails: frozenset[str] = _set("email mail mailto contact write send reach address account cc bcc forward reply schreiben schreib kontakt écrire écrivez contactez correo escribir escriba e")
    #: words of other numbers
    others: frozenset[str] = _set(
        "isbn issn doi ticket issue bug order invoice tracking shipment version build release revision page pages chapter line lines row rows port host server ip commit hash sha md5 digest checksum price total sum costs coins bytes kb mb gb points score room table figure step year date time run "
        "bestellung rechnung seite zeile preis commande facture pedido factura página d20 d6 d8 roll dice"
    )


LEXICON = Lexicon()

# --- generators ----------------------------------------------------------------------------------

_UPPER, _LETTER = "A-ZÀ-ÖØ-ÞŒŠŽĆČŁŃŚŹŻ", "A-Za-zÀ-ÖØ-öø-ÿŒœŠšŽžĆćČčŁłŃńŚśŹźŻżĀ-ž"
_TOKEN = rf"(?:(?:Dr|Mr|Mrs|Ms|Mx|Prof|Rev|Sra?|Srta|Mme|Mlle|Hr|Fr|Dipl|Ing|St)\.|(?:O|D|L)[’'][{_UPPER}][{_LETTER}]+|[{_UPPER}][{_LETTER}’'-]*[{_LETTER}]|[{_UPPER}]\.|[{_UPPER}](?![{_LETTER}\d]))"
_PARTICLE = r"(?:(?:(?:van|von)(?:[ \t](?:der|den|dem))?|zu|zur|de(?:[ \t](?:la|los|las))?|da|dos|di|della|del|du|ten|ter|bin|ibn)[ \t])"
_RUN = re.compile(rf"(?<![\w@+.’'/-]){_TOKEN}(?:(?:,[ \t]|[ \t]{_PARTICLE}?){_TOKEN})+")
_ONE = re.compile(_TOKEN)
_ELIDED = re.compile(rf"(?:[CDJLMNST]|Qu)[’'](?![{_UPPER}])")
_EMAIL = re.compile(
    r"(?<![\w.+@/-])[\w.+-]*\w@[^\W_][\w-]*(?:\.[^\W_][\w-]*)*"
    r"|(?<![\w.+@/-])[\w.+-]*\w ?(?:\(at\)|\[at\]|\{at\}|<at>|\(@\)|\[@\]| at | AT ) ?[^\W_][\w-]*(?: ?(?:\(dot\)|\[dot\]|\{dot\}|<dot>|\(\.\)|\[\.\]| dot | punkt | point |\.) ?[^\W_][\w-]*)+",
    re.I,
)
_AT = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}|<at>|\(@\)|\[@\]| at ) ?", re.I)
_EXTENSION = r"(?:[ ,]*(?:ext\.?|x|durchwahl|dw|poste|extensión)[ ]?\d{1,5})"
_NUMBER = re.compile(rf"(?<![\w@.:/+-])(?:\+ ?\d|\(\+?\d|\d)[\d ()./–-]{{5,28}}\d(?!\d)(?:{_EXTENSION})?[A-Z]?\b", re.I)
_CODE = re.compile(r"(?<![\w@.:/+-])(?=[A-Z0-9-]*\d[A-Z0-9-]*\d[A-Z0-9-]*\d)(?=[A-Z0-9-]*[A-Z])[A-Z0-9][A-Z0-9-]{5,18}[A-Z0-9](?![\w-])|(?<![\w@.:/+-])[A-Z]{2}(?: \d\d){3} [A-D]\b")
_TOWN = rf"[{_UPPER}][{_LETTER}’'-]+"
_WORD_CAP = rf"[{_UPPER}][{_LETTER}’'-]*"
_ADDRESS = re.compile(
    rf"(?:(?P<plain>(?<![\w.:/-])(?<!\d )\d{{1,5}}[A-Za-z]?,? (?:(?:[NSEW]\.? )?{_WORD_CAP} ){{1,3}}{_WORD_CAP}\.?)"
    rf"|(?P<joined>\b(?:{_WORD_CAP} )?{_WORD_CAP}?(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|damm|ring|pfad|steig|straat|laan|plein|vägen|gatan|vej|gade|Straße|Strasse|Str\.|Weg|Platz|Gasse|Allee|Ufer|Damm|Ring)[ ]\d{{1,4}} ?[a-z]?\b)"
    rf"|(?P<prepositional>\b(?:Am|An der|Im|Auf der|Auf dem|Zum|Zur|Unter den) {_WORD_CAP} \d{{1,4}} ?[a-z]?\b)"
    rf"|(?P<before>(?<![\w.:/-])\d{{1,4}}(?: ?bis| ?ter)?,? (?:rue|avenue|boulevard|place|chemin|impasse|allée|quai|cours|route|square|passage) (?:d[eu]s? |de la |de l[’']|d[’']|la |le |les )?{_TOWN}(?: {_TOWN})?)"
    rf"|(?P<after>\b(?:Calle|Avenida|Avda\.?|Plaza|Paseo|Camino|C/|Via|Viale|Corso|Piazza|Rua|Carrer|Ulica|Ul\.) ?(?:del |de la |de los |de las |de |la |el |della |dei )?{_TOWN}(?: {_TOWN})?,? (?:n[º°.] ?)?\d{{1,4}}))"
    rf"(?P<town>, (?:\d{{4,5}} )?{_TOWN}|,? \d{{4,5}} {_TOWN}|\n{_TOWN} [A-Z]{{1,2}}\d[A-Z\d]? ?\d[A-Z]{{2}})?"
)
#: English words that end the name of a road.
ROADS = _set("street st road rd lane ln avenue ave drive dr court ct way place pl square sq terrace close crescent boulevard blvd row alley grove mews parade walk highway")
_POST = re.compile(rf"^[ .,\n]*(?:\d{{4,5}}[ ,]|[A-Z]{{1,2}}\d|[{_UPPER}][{_LETTER}-]+[ ,\n]+(?:[A-Z]{{1,2}}\d|\d{{5}})|[{_UPPER}])")
_WORDS = re.compile(r"[^\W_]+")
#: Context is looked for within the sentence; a full stop right before a span belongs to an abbreviation.
_STOP = re.compile(r"[.!?](?=\s+[^\W_])|\n")
_CONTEXT = 40

Span = tuple[int, int, list[float]]
#: How usual words are in lower case: 1 mostly, -1 hardly ever; others are unknown.
Usual = dict[str, int]


def _around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    near = text[max(0, start - _CONTEXT) : start]
    cut = max((m.start() for m in _STOP.finditer(near)), default=0)
    after = text[end : end + _CONTEXT]
    stop = _STOP.search(after)
    return _WORDS.findall(near[cut:].lower())[-4:], _WORDS.findall(after[: stop.start() if stop else None].lower())[:3]


def _cues(words: frozenset[str], before: list[str], others: frozenset[str]) -> list[float]:
    last = before[-1] if before else ""
    return [float(last in words), float(sum(w in words for w in before)), float(sum(w in others for w in before)), float(last in others)]


def email_spans(text: str, usual: Usual, lex: Lexicon) -> list[Span]:
    low = text.lower()
    if "@" not in low and " at " not in low and "at]" not in low and "at)" not in low and "at}" not in low and "at>" not in low:
        return []
    out = []
    for m in _EMAIL.finditer(text):
        s = m.group()
        before, _ = _around(text, *m.span())
        local, _, host = s.partition("@")
        spoken = not host or not host[:1].isalnum()
        if spoken:
            local, host = (_AT.split(s, maxsplit=1) + [""])[:2]
        parts = [p for p in re.split(r"[\W_]+|\b(?:dot|punkt|point)\b", host, flags=re.I) if p]
        rest = text[m.end() : m.end() + 2]
        marked = bool(re.search(r"[(\[{<](?:at|@)|[(\[{<](?:dot|\.)| (?:dot|punkt|point) ", s, re.I))
        odd = any(c in "+_.-" or c.isdigit() for c in local)
        out.append((m.start(), m.end(), [
            float(spoken), float(len(parts)), float(len(parts[-1])) if parts else 0.0, float(bool(parts) and parts[-1].isalpha()), float(rest[:1] in (":", "$", "/", "#") and rest[1:2].strip() != ""), float(marked), float(odd), float(len(local)),
            float(local.lower() in lex.function | lex.articles), float(usual.get(local.lower(), 0)), float(bool(parts) and all(p.isdigit() for p in parts)), *_cues(lex.emails, before, lex.others),
        ]))
    return out


#: Calling codes of countries, and how many digits follow.
CALLING = {"1": (10, 10), "44": (9, 10), "49": (6, 11), "33": (9, 9), "34": (9, 9), "39": (8, 11), "41": (9, 9), "43": (7, 12), "31": (9, 9), "32": (8, 9), "351": (9, 9), "353": (7, 9), "45": (8, 8), "46": (7, 10), "47": (8, 8), "48": (9, 9), "61": (9, 9), "91": (10, 10), "81": (9, 10), "86": (10, 11), "55": (10, 11)}


def _planned(text: str) -> tuple[float, float]:
    """(whether a country's calling code leads, whether the digits that follow are as many as its plan asks for)."""
    digits = re.sub(r"\D", "", text.replace("(0)", ""))
    lead = 1 if text.lstrip("(")[:1] == "+" else 2 if digits[:2] == "00" else 0
    if not lead:
        return 0.0, float(10 <= len(digits) <= 11 and digits[0] == "0" or len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789" or len(digits) == 9 and digits[0] in "6789")
    digits = digits[2:] if lead == 2 else digits
    for size in (3, 2, 1):
        if digits[:size] in CALLING:
            low, high = CALLING[digits[:size]]
            return 1.0, float(low <= len(digits) - size <= high)
    return 0.0, 0.0


#: Fixed value: check letters of Spanish identity numbers.
CHECK_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def _checked(s: str) -> float:
    """Whether check digits or reserved ranges of some national number hold."""
    t = re.sub(r"[ .-]", "", s.upper())
    if re.fullmatch(r"[XYZ]?\d{7,8}[A-Z]", t):
        return float(CHECK_LETTERS[int(t[:-1].translate(str.maketrans("XYZ", "012"))) % 23] == t[-1])
    if re.fullmatch(r"[12]\d{14}", t):
        return float(97 - int(t[:13]) % 97 == int(t[13:]))
    if re.fullmatch(r"\d{9}", t) and "-" in s:
        return float(t[:3] not in ("000", "666") and t[0] != "9" and t[3:5] != "00" and t[5:] != "0000")
    if re.fullmatch(r"\d{11}", t):
        return float(sum(w * int(c) for w, c in zip((1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1), t)) % 10 == 0)
    if re.fullmatch(r"\d{10}", t):
        total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(t))
        return float(total % 10 == 0)
    return 0.0


# Shapes of national, social security, passport and identity card numbers.
SHAPES = [
    r"\d{3}-\d\d-\d{4}", r"\d{6}[-+]\d{4}|\d{8}-\d{4}", r"[XYZ]?\d{7,8}-?[A-Z]", r"[A-Z]{1,2}\d{6,8}", r"[12] ?\d\d ?\d\d ?\d[\dAB] ?\d{3} ?\d{3}(?: ?\d\d)?", r"[A-Z](?=[A-Z0-9]{8}$)(?=.*\d)[A-Z0-9]{8}", r"[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D]",
    r"[A-Z]{6}\d\d[A-Z]\d\d[A-Z]\d{3}[A-Z]", r"756\.\d{4}\.\d{4}\.\d\d", r"\d\d\.\d\d\.\d\d-\d{3}\.\d\d", r"\d{9}", r"\d{11}",
]
_SHAPES = [re.compile(s) for s in SHAPES]


def number_spans(text: str, usual: Usual, lex: Lexicon) -> list[Span]:
    """Candidates for phone and identity numbers, with the features that both models use."""
    out = []
    for pattern, code in ((_NUMBER, 0.0), (_CODE, 1.0)):
        for m in pattern.finditer(text):
            s = m.group()
            bare = s if code else re.sub(rf"(?i){_EXTENSION}$", "", s)
            digits = [g for g in re.split(r"\D+", bare) if g]
            n = sum(map(len, digits))
            if n < 5:
                continue
            before, after = _around(text, *m.span())
            seps = [float(bare.count(c)) for c in " -./("]
            date = float(bool(re.search(r"(?<!\d)(?:(?:19|20)\d\d[-./]\d\d?[-./]\d\d?(?!\d)|\d\d?[./-]\d\d?[./-](?:19|20)\d\d(?!\d))", s)))
            dotted = float(bool(re.match(r"\d{1,3}(\.\d{1,3}){3}$", s)))
            book = float("isbn" in before or bool(re.match(r"97[89][ -]?\d", s) and n == 13))
            clock = float(bool(re.match(r"\s?:\d", text[m.end() : m.end() + 2])) or bool(re.search(r"\d:$", text[max(0, m.start() - 2) : m.start()])))
            thousands = float(bool(re.fullmatch(r"\d{1,3}(?:([ .])\d{3})(?:\1\d{3})*", s)))
            hexed = float(bool(code) and bool(re.fullmatch(r"[0-9A-F]+", s)))
            led, planned = _planned(bare) if not code else (0.0, 0.0)
            out.append((m.start(), m.end(), [
                code, float(n), float(len(digits)), float(len(digits[0])), float(len(digits[-1])), float(max(map(len, digits))), float(s[0] == "+"), float(s[:2] == "00"), float(s[0] == "0"), float(s[0] == "("), *seps, date, dotted, book, clock, thousands, hexed,
                float(sum(c.isalpha() for c in bare)), float(bare != s), led, planned, _checked(bare), *[float(bool(p.fullmatch(bare))) for p in _SHAPES], *_cues(lex.phones, before, lex.others), *_cues(lex.ids, before, lex.others)[:2],
                float(bool(after) and after[0] in lex.others),
            ]))
    return out


FORMS = ("plain", "joined", "prepositional", "before", "after")


def address_spans(text: str, usual: Usual, lex: Lexicon) -> list[Span]:
    out = []
    for m in _ADDRESS.finditer(text):
        before, after = _around(text, *m.span())
        form = next(g for g in FORMS if m[g])
        words = _WORDS.findall(m[form].lower())
        road = float(any(w in ROADS for w in words[2:])) if form == "plain" else 1.0
        rest = text[m.end(form) : m.end(form) + 24]
        out.append((m.start(), m.end(), [
            *[float(form == g) for g in FORMS], road, float(bool(_POST.match(rest))), float(rest[:1] == ","), float(bool(words) and words[-1] in ROADS), float(bool(m["town"])), float(bool(after) and after[0] in lex.acts | lex.function),
            *_cues(lex.homes, before, lex.others),
        ]))
    return out


def name_spans(text: str, usual: Usual, lex: Lexicon) -> list[Span]:
    out = []
    for run in _RUN.finditer(text):
        tokens = [(t.start() + run.start(), t.end() + run.start(), t.group()) for t in _ONE.finditer(run.group())]
        line = text[text.rfind("\n", 0, run.start()) + 1 : run.start()]
        led = [*_around(text, run.start(), run.end())[0][-1:], *(t[2].lower() for t in tokens)]
        for size in (2, 3, 4):
            for k in range(len(tokens) - size + 1):
                part = tokens[k : k + size]
                start, end = part[0][0], part[-1][1]
                words = [t[2].rstrip(".").lower() for t in part]
                titled = words[0] in lex.titles and len(words[0]) > 1
                if not titled and part[0][2][-1] != "." and (words[0] in lex.articles or words[0] in lex.function or words[0] in lex.places or _ELIDED.match(part[0][2])):
                    continue
                before, after = _around(text, start, end)
                opening = text[:start].rstrip(" ")[-1:]
                initials = sum(len(w) == 1 for w in words)
                core = words[1:] if titled else words
                known = [usual.get(w, 0) for w in core if len(w) > 1] or [0]
                last, prior = words[-1], before[-1] if before else ""
                out.append((start, end, [
                    float(size), float(titled), float(core[0] in lex.given), float(last in lex.given), float(any(w in lex.given for w in core)), float(initials), float(len(words[0]) == 1), float(len(last) == 1), float("," in text[start:end]),
                    float(text[start:end].isupper()), float(len(text[start:end].split()) - size), float(opening in ("", ".", "!", "?", "\n")), float(any(len(w) > 1 and (w in lex.function or w in lex.articles) for w in words)), float(sum(w in lex.bodies for w in words)), float(last in lex.bodies),
                    float(prior in lex.articles), float(any(w in lex.articles for w in led[: k + 1])), float(prior in lex.places), float(bool(after) and after[0] in lex.acts), float(bool(after) and after[0] in lex.bodies), float(bool(after) and after[0][:1].isdigit()), float(prior[:1].isdigit()),
                    float(len(last)), float(len(core[0])), float(known[0]), float(known[-1]), float(max(known)), float(sum(x > 0 for x in known) / len(known)), float(len(tokens) - size), float(k), float("#" in line or "|" in line),
                    *_cues(lex.persons, before, lex.others),
                ]))
    return out


GENERATORS: dict[str, Callable[[str, Usual, Lexicon], list[Span]]] = {"email": email_spans, "phone": number_spans, "id_number": number_spans, "address": address_spans, "name": name_spans}


# --- what words are usual ------------------------------------------------------------------------


@lru_cache(maxsize=2)
def spellings(folder: str = TOKENIZERS, name: str = VOCABULARY) -> Usual:
    """Of the words of a public vocabulary, which stands earlier, that is more often: in lower case (1) or with a capital (-1)."""
    path = Path(folder) / name
    if not path.exists():
        return {}
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in path.read_bytes().splitlines() if line)}
    out: Usual = {}
    for token, rank in ranks.items():
        word = token.decode("utf-8", "replace")
        if word[:1] == " " and len(word) > 3 and word[1:].isalpha():
            other = ranks.get((" " + (word[1:].lower() if word[1].isupper() else word[1:].capitalize())).encode(), 1 << 30)
            out[word[1:].lower()] = (1 if rank < other else -1) if word[1:].islower() else (-1 if rank < other else 1)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    capital, low = Counter(), Counter()
    for batch in batches:
        for texts in batch.column("texts").to_pylist():
            for text in texts or ():
                for w in _WORDS.findall(text):
                    if len(w) > 2:
                        if w[0].isupper():
                            capital[w.lower()] += 1
                        else:
                            low[w] += 1
    words = list(capital.keys() | low.keys())
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([capital[w] for w in words], pa.int64()), pa.array([low[w] for w in words], pa.int64())], names=["word", "capital", "low"])


def statistics(texts: DataFrame) -> Usual:
    """Which words the collection writes mostly in lower case (1) or hardly ever (-1). texts: (texts).

    Words below ``WORD_SHARE`` of all are left out, which bounds the table whatever the collection's size.
    """
    words = texts.select("texts").mapInArrow(_count, "word string, capital long, low long").groupBy("word").agg(F.sum("capital").alias("capital"), F.sum("low").alias("low"))
    words = materialize(words.withColumn("n", F.col("capital") + F.col("low")), "spellings")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    kept = words.filter(F.col("n") >= max(WORD_FROM, WORD_SHARE * total)).select("word", F.when(F.col("low") * 2 >= F.col("n"), 1).when(F.col("low") * 20 < F.col("n"), -1).otherwise(0).alias("usual"))
    return {r["word"]: r["usual"] for r in kept.collect()}


# --- made-up candidates to fit on ----------------------------------------------------------------


class _Maker:
    """Texts with a known span, made by rule: a format from a grammar, context words drawn one by one."""

    def __init__(self, seed: int, lex: Lexicon) -> None:
        self.r, self.lex = random.Random(seed), lex
        self.usual: Usual = {}
        self.given_names = sorted(lex.given)

    def pick(self, *options):
        return self.r.choice(options)

    def often(self, share: float) -> bool:
        return self.r.random() < share

    def digits(self, pattern: str) -> str:
        """9 stands for any digit, 8 for any but 0 and 1, A for a capital."""
        return "".join(str(self.r.randrange(10)) if c == "9" else str(self.r.randrange(2, 10)) if c == "8" else self.pick(*"ABCDEFGHJKLMNPRSTVWXYZ") if c == "A" else c for c in pattern)

    def word(self, parts: int | None = None) -> str:
        onset, core, end = "b c d f g h j k l m n p r s t v w z br ch dr fr gl kl pr sch st th tr".split(), "a e i o u ai au ei ie ou".split(), " n r l s t m ck nd rt st".split(" ")
        return "".join(self.pick(*onset) + self.pick(*core) + self.pick(*end) for _ in range(parts or self.r.randrange(1, 4)))

    def known(self, word: str, common: float, proper: float) -> str:
        """The word, told to be mostly lower case or mostly capital with these chances."""
        x = self.r.random()
        if x < common + proper:
            self.usual[word.lower()] = 1 if x < common else -1
        return word

    def noun(self) -> str:
        return self.known(self.word(self.r.randrange(1, 6)), 0.85, 0.02)

    def given(self) -> str:
        if self.often(0.3):
            return self.pick(*self.given_names).capitalize()
        return self.known(self.word().capitalize(), 0.08, 0.5)

    def surname(self) -> str:
        made = self.word().capitalize() + self.pick("", "", "", "s", "son", "er", "mann", "ez", "ova", "ini", "ski")
        if self.often(0.06):
            made = self.pick("O’", "Mc", "D'") + made
        if self.often(0.06):
            made += "-" + self.word().capitalize()
        return self.known(made, 0.15, 0.3)

    def place(self) -> str:
        return self.known(self.word().capitalize(), 0.1, 0.4)

    def some(self, words: frozenset[str]) -> str:
        return self.r.choice(sorted(words))

    def context(self, cues: frozenset[str], direct: float, near: float, avoid: float) -> str:
        """Up to four words before a span: a cue right before it, one further off, a word of other numbers, or none of these."""
        words = [self.pick(self.noun(), self.some(self.lex.function), self.some(self.lex.articles)) for _ in range(self.r.randrange(0, 4))]
        while cues is self.lex.persons and words and words[-1] in self.lex.articles | self.lex.places:
            words.pop()
        if words and self.often(near):
            words[self.r.randrange(len(words))] = self.some(cues)
        if self.often(direct):
            words.append(self.some(cues))
        elif self.often(avoid):
            words.append(self.some(self.lex.others))
        elif self.often(0.25):
            words.append(self.pick("is", "ist", "est", "es", "was"))
        text = " ".join(words)
        text = text.capitalize() if self.often(0.6) else text
        return text + (self.pick(" ", ": ", " ", " (", ", ", ". ") if text else "")

    def after(self) -> str:
        if self.often(0.25):
            return self.pick("", ".", ")", "!", "\n")
        return self.pick(" ", ", ", ". ", " ") + " ".join(self.pick(self.noun(), self.some(self.lex.function)) for _ in range(self.r.randrange(1, 4))) + "."

    # formats

    def email(self) -> str:
        names = [self.word(1), self.noun() if self.often(0.4) else self.word(2)]
        local = self.pick(lambda: ".".join(names), lambda: names[1] + self.digits("99"), lambda: self.word(1)[0] + self.pick("_", ".", "-", "") + names[1], lambda: names[1] + "+" + self.word(1), lambda: names[1])()
        host = ".".join([*([self.word(1)] if self.often(0.25) else []), self.word(2), self.pick("org", "com", "net", "info", "co", "de", "fr", "es", "eu", "io", "example", "test", "invalid")])
        if self.often(0.4):
            at, dot = self.pick((" at ", " dot "), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" {at} ", "."), ("(at)", "."), (" [at] ", "."), ("<at>", "."), (" at ", " dot "))
            made = local + at + host.replace(".", dot)
        else:
            made = f"{local}@{host}"
        return made.upper() if self.often(0.12) else made

    def phone(self) -> str:
        d = self.digits
        national = self.pick(
            "(899) 899-9999", "(899) 899 9999", "899-899-9999", "899.899.9999", "899 899 9999", "8998999999", "8998999999", "8998999999", "1-899-899-9999", "09 99 99 99 99", "09.99.99.99.99", "0999999999", "020 9999 9999", "(020) 9999 9999", "01999 999999", "07999 999999", "07999 999 999", "0899/9999999", "0899 9999-99",
            "089 99 99 99", "0179-9999999", "01799 999999", "030/99999-999", "0899-99999999", "699 999 999", "699 99 99 99", "91 999 99 99", "079 999 99 99", "0664 9999999", "06-99999999", "899-9999",
        )
        made = d(national)
        if self.often(0.4):
            code = self.pick("1", "44", "49", "33", "34", "39", "41", "43", "31", "32", "46", "48")
            body = {"1": self.pick("(899) 899-9999", "899 899 9999", "899-899-9999", "8998999999", "899.899.9999"), "33": self.pick("8 99 99 99 99", "899999999", "(0)8 99 99 99 99"), "34": self.pick("699 999 999", "699 99 99 99"), "44": self.pick("20 9999 9999", "7999 999999", "7999 999 999", "(0)20 9999 9999")}.get(
                code, self.pick("89 999999", "899 9999999", "89 9999 999", "89 99999 99", "89-99999999", "89 99999-999", "(0)89 9999999", "89 999 99 99", "8999999999")
            )
            made = d(self.pick(f"+{code} ", f"+{code} ", f"+{code}", f"+{code}-", f"00{code} ", f"00{code}-", f"(+{code}) ") + body)
            if made.startswith("+1 ("):
                made = made if self.often(0.7) else made.replace("+1 (", "+1(")
        if self.often(0.08):
            made += self.pick(" ext. ", " x", ", ext ", " ext ") + d(self.pick("99", "999", "9"))
        return made

    def id_number(self) -> str:
        d = self.digits
        label = self.pick("", "", "no. ", "nr. ", "number ", "Nr. ")
        dni = d("99999999")
        made = self.pick(
            d("999-99-9999"), d("999-99-9999"), d("6") + d("66-99-9999"), d("999999999"), d("999 99 9999"), dni + CHECK_LETTERS[int(dni) % 23], d("99999999A"), d("X9999999A"), d("99999999-A"), d("AA 99 99 99 A").replace("99 A", "99 " + self.pick("A", "B", "C", "D")), d("AA999999") + self.pick("A", "B", "C", "D"),
            self.pick("1", "2") + d(" 99 ") + f"{self.r.randrange(1, 13):02d}" + d(" 99 999 999 99"), self.pick("1", "2") + d("99") + f"{self.r.randrange(1, 13):02d}" + d("9999999999"), self.pick("1", "2") + d(" 99 ") + f"{self.r.randrange(1, 13):02d}" + d(" 99 999 999"), d("A9999999"), d("A99999999"), d("AA9999999"), d("A99A99A99"), d("L9AA99A9A"),
            d("A99AA9A99"), f"{self.r.randrange(20, 99)}{self.r.randrange(1, 13):02d}{self.r.randrange(1, 29):02d}" + d("-9999"), d("19") + f"{self.r.randrange(20, 99)}{self.r.randrange(1, 13):02d}{self.r.randrange(1, 29):02d}" + d("-9999"), d("756.9999.9999.99"), d("99.09.19-999.99"), d("AAAAAA99A99A999A"), d("99999999999"), d("999999999"),
        )
        plain = made.isdigit()
        name = self.pick("SSN", "social security", "passport", "identity card", "national id", "NIR", "DNI", "NINO", "Ausweis", "Reisepass", "ID", "BSN", "pasaporte", "PESEL") if plain or self.often(0.45) else ""
        return f"{name} {label}{made}" if name else made

    def address(self) -> str:
        street, d = self.pick(self.word().capitalize(), self.noun().capitalize()), self.digits(self.pick("8", "89", "89", "899"))
        town, letter = self.place(), self.pick("", "", "", "a", "b")
        made = self.pick(
            f"{d} {street} {self.pick(*ROADS_WRITTEN)}", f"{d} {street} {self.pick(*ROADS_WRITTEN)}", f"{d}{letter.upper()} {self.pick('N', 'South', 'Old', 'New', 'Upper')} {street} {self.pick(*ROADS_WRITTEN)}", f"{street}{self.pick('straße', 'strasse', 'weg', 'platz', 'gasse', 'allee', 'ring', 'str.', 'damm')} {d}{letter}",
            f"{self.place()}er {self.pick('Straße', 'Weg', 'Allee', 'Platz', 'Str.')} {d}{letter}", f"Am {street} {d}", f"{d}{self.pick('', ' bis', ' ter', ',')} {self.pick('rue', 'avenue', 'boulevard', 'place', 'chemin', 'quai', 'impasse')} {self.pick('', 'de la ', 'du ', 'des ', 'de ')}{street}",
            f"{self.pick('Calle', 'Avenida', 'Plaza', 'Paseo', 'C/')} {self.pick('', 'de ', 'del ', 'de la ')}{street}{self.pick(' ', ', ', ' nº ')}{d}", f"{self.pick('Via', 'Viale', 'Corso', 'Piazza')} {street} {d}", f"{street}{self.pick('straat', 'gatan', 'laan', 'vej')} {d}",
        )
        return made + self.pick("", f", {town}", self.digits(f", 99999 {town}"), self.digits(f", 9999 {town}"), "\n" + town + self.digits(" AA9 9AA"), self.digits(f" 99999 {town}"))

    def name(self) -> str:
        title = self.pick("Mr", "Mrs", "Ms", "Dr.", "Dr", "Prof.", "Professor", "Mr.", "Mrs.", "Herr", "Frau", "Sr.", "Sra.", "Señora", "Mme", "Monsieur", "Madame", "Mlle", "Miss", "Herrn", "Sir")
        first, last, initial = self.given(), self.surname(), self.digits("A")
        made = self.pick(
            f"{first} {last}", f"{first} {last}", f"{first} {last}", f"{title} {last}", f"{title} {last}", f"{title} {first} {last}", f"{initial}. {last}", f"{initial}. {last}", f"{initial}. {self.digits('A')}. {last}", f"{first} {initial}. {last}", f"{last}, {first}", f"{last}, {initial}.", f"{first} {self.given()} {last}", f"{first} {self.pick('van', 'von', 'de', 'da', 'de la', 'van der')} {last}",
        )
        return made.upper() if self.often(0.1) else made

    # what is none

    def other_number(self) -> str:
        d, r = self.digits, self.r
        return self.pick(
            lambda: "ISBN " + d("978-9-999-99999-9"), lambda: d("978-9-99-999999-9"), lambda: d("979 9 99 999999 9"), lambda: f"{r.randrange(1990, 2040)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}", lambda: f"{r.randrange(1, 29):02d}.{r.randrange(1, 13):02d}.{r.randrange(1990, 2040)}",
            lambda: f"{r.randrange(1, 29):02d}/{r.randrange(1, 13):02d}/{r.randrange(1990, 2040)} {r.randrange(10, 24)}:{r.randrange(10, 60)}", lambda: f"{r.randrange(1990, 2040)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d} {r.randrange(10, 24)}:{r.randrange(10, 60)}", lambda: f"{r.randrange(1990, 2040)}.{r.randrange(1, 13):02d}" + d(".9999"),
            lambda: ".".join(str(r.randrange(1, 256)) for _ in range(4)), lambda: d(self.pick("9999-9999-99", "99-999999", "999999", "9999-99999", "9999999", "99999999", "999-9999999-9999999")), lambda: f"{r.randrange(1000, 5000)}-{r.randrange(5000, 9999)}", lambda: d(self.pick("89 999 999", "8 999 999", "8.999.999", "899 999", "8 999 999 999")),
            lambda: "".join(r.choice("0123456789abcdef") for _ in range(self.pick(8, 12, 40))), lambda: "".join(r.choice("0123456789ABCDEF") for _ in range(self.pick(8, 12, 16))), lambda: d("99999999"), lambda: d(self.pick("AA-9999-99", "AAA-99999", "AA99-9999", "A-99999-99")), lambda: d("9999999999"), lambda: d("89.999999, 8.999999"), lambda: d("1899999999"),
        )()

    def other_name(self) -> tuple[str, bool]:
        """(words in capitals that are no person, whether an article goes before)."""
        body, noun, place = self.some(self.lex.bodies).capitalize(), self.noun().capitalize(), self.place()
        proper = self.known(self.word().capitalize(), 0.1, 0.6)
        return self.pick(
            (f"{place} {body}", self.often(0.6)), (f"{noun} {body}", self.often(0.6)), (f"{noun} {self.noun().capitalize()}", self.often(0.6)), (f"{proper} {noun}", self.often(0.3)), (f"{body} {place}", self.often(0.4)), (f"{noun} {self.noun().capitalize()} {body}", self.often(0.5)),
            (f"{noun} {self.pick('von', 'de', 'del', 'di', 'da')} {place}", self.often(0.8)), (f"{noun} {self.pick('von', 'de', 'del', 'di', 'da')} {place}", self.often(0.8)),
            (f"{self.pick('San', 'Port', 'Mount', 'Lake', 'New', 'Saint', 'Bad', 'Los')} {place}", False), (f"{noun} {self.noun().capitalize()}", False), (f"{place} {noun}", self.often(0.5)), (f"{self.some(self.lex.function).capitalize()} {place}", False),
        )

    def other_email(self) -> str:
        w = self.word
        return self.pick(f"{w()}@{w()}:~$ ls", f"@{w()}_{self.digits('99')}", f"git@{w()}.{self.pick('org', 'com')}:{w()}/{w()}.git", f"{w()} at {w()}", f"{w()} at {w()}. {w().capitalize()}", f"@{w()}/{w()}@{self.digits('9.9.9')}", f"{w()}@{w()}", f"{w()} at {self.digits('9.99')}", f"{w()}@{self.digits('9.9')}", f"{w()} at {w()}.{w()} dot")

    def other_address(self) -> str:
        p, n = self.place, lambda: self.noun().capitalize()
        return self.pick(
            f"{self.digits('89')} {p()} and {p()}", f"{self.digits('8')} {n()} {n()} {self.noun()}", f"{self.digits('899')} {p()} {self.some(self.lex.bodies)}", f"{n()} {self.digits('8')}", f"{self.pick('Chapter', 'Page', 'Room', 'Kapitel', 'Seite', 'Act')} {self.digits('8')} {n()} {n()}", f"{self.digits('1899')} {n()} {n()} {n()}",
            f"{p()} {self.pick('Street', 'Road', 'Lane')}", f"{self.digits('89')} {n()} {n()}", f"rue {n()}", f"{self.digits('89')} {self.pick('May', 'June', 'January')} {n()}",
        )

    def sample(self, kind: str, case: bool) -> tuple[str, tuple[int, int] | None]:
        lex = self.lex
        cues = {"email": lex.emails, "phone": lex.phones, "id_number": lex.ids, "address": lex.homes, "name": lex.persons}[kind]
        head = (self.noun() + self.pick(". ", "! ", "\n", " ")) if self.often(0.4) else ""
        if case:
            span = getattr(self, kind)()
            before = head + (self.context(cues, 0.45, 0.3, 0.03) if self.often(0.8) else "")
            tail = (" " + self.some(lex.acts) + self.after()) if kind == "name" and self.often(0.35) else self.after()
            if kind == "name" and self.often(0.15):
                before += self.some(lex.places) + " "
            if self.often(0.06):
                before, tail = before + self.pick("<", "(", "“"), self.pick(">", ")", "”") + tail
            return before + span + tail, (len(before), len(before) + len(span))
        article = False
        if self.often(0.3):
            # an address that holds what looks like a name is taken before it
            other = self.pick(*[k for k in KINDS if k != kind and (kind, k) != ("name", "address")])
            span = getattr(self, other)()
        elif kind == "name":
            span, article = self.other_name()
        else:
            span = {"email": self.other_email, "address": self.other_address}.get(kind, self.other_number)()
        before = head + self.context(cues, 0.08, 0.12, 0.45)
        if article:
            before += self.some(lex.articles) + " "
            before = before.capitalize() if not head and self.often(0.4) else before
        elif kind == "name" and self.often(0.35):
            before += self.some(lex.places) + " "
        return before + span + self.after(), None


#: Ends of English road names as they are written.
ROADS_WRITTEN = "Street St. St Road Rd Lane Avenue Ave Ave. Drive Court Way Place Square Terrace Close Crescent Boulevard Row Grove".split()


@lru_cache(maxsize=2)
def models(samples: int = SAMPLES, seed: int = 7, lex: Lexicon = LEXICON) -> dict[str, Boosted]:
    """A fitted model for each kind. A candidate is a case if it covers most of the made-up span."""
    fitted = {}
    for i, kind in enumerate(KINDS):
        maker, rows, classes = _Maker(seed + i, lex), [], []
        for k in range(samples):
            text, span = maker.sample(kind, k % 2 == 0)
            for start, end, features in GENERATORS[kind](text, maker.usual, lex):
                inside = min(end, span[1]) - max(start, span[0]) if span else 0
                case = span is not None and inside > (0.3 if kind == "address" else 0.6) * (end - start) and inside > 0.5 * (span[1] - span[0])
                if kind == "name" and case and (start, end) != span:
                    # of the candidates on one name the whole one is right, and those that only lack an outer part do no harm
                    if start < span[0] or end > span[1]:
                        case = False
                if kind in ("phone", "id_number") and span and inside > 0.6 * (end - start) and inside >= 7:
                    case = True
                rows.append(features)
                classes.append(float(case))
        fitted[kind] = Boosted(trees=140, rate=0.12).fit(np.array(rows), np.array(classes))
    return fitted


class Finder:
    def __init__(self, fitted: dict[str, Boosted], usual: Usual | None = None, lex: Lexicon = LEXICON) -> None:
        self.models, self.usual, self.lex = fitted, usual or {}, lex

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """The chosen spans of each text in order, none overlapping another."""
        found: list[list[tuple[float, int, int, str]]] = [[] for _ in texts]
        makers: list[tuple[tuple[str, ...], Callable[[str, Usual, Lexicon], list[Span]]]] = [(("email",), email_spans), (("phone", "id_number"), number_spans), (("address",), address_spans), (("name",), name_spans)]
        for kinds, generate in makers:
            owner, spans, rows = [], [], []
            for i, text in enumerate(texts):
                if text:
                    for start, end, features in generate(text, self.usual, self.lex):
                        owner.append(i)
                        spans.append((start, end))
                        rows.append(features)
            if not rows:
                continue
            matrix = np.array(rows, np.float32)
            chances = np.stack([self.models[k].predict(matrix) - self.models[k].threshold for k in kinds])
            best = chances.argmax(axis=0)
            for j in np.flatnonzero(chances.max(axis=0) >= 0):
                found[owner[j]].append((float(chances[best[j], j]), *spans[j], kinds[best[j]]))
        out = []
        for hits in found:
            kept: list[tuple[int, int, str]] = []
            # a name inside an address or a number inside an email address is part of it
            rank = {"email": 0, "address": 1, "id_number": 2, "phone": 2, "name": 3}
            for _, start, end, kind in sorted(hits, key=lambda h: (rank[h[3]], -(h[2] - h[1]), -h[0])):
                if all(end <= s or start >= e for s, e, _ in kept):
                    kept.append((start, end, kind))
            out.append(sorted(kept))
        return out


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, last = [], 0
    for start, end, kind in spans:
        parts += [text[last:start], PLACEHOLDER[kind]]
        last = end
    return "".join([*parts, text[last:]])


def _apply(fitted: dict[str, Boosted], usual: Usual, rewritten: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(fitted, usual)
        for batch in batches:
            lists = batch.column("texts").to_pylist()
            flat = [t for texts in lists for t in texts or ()]
            spans = finder.spans(flat)
            rows, at = [], 0
            for table, ref_id, texts in zip(batch.column("src_table").to_pylist(), batch.column("ref_id").to_pylist(), lists):
                own = spans[at : at + len(texts or ())]
                kinds = sorted({k for hits in own for _, _, k in hits})
                if rewritten and kinds:
                    rows.append((table, ref_id, kinds, [redact(t, hits) for t, hits in zip(texts, own)]))
                elif not rewritten:
                    rows += [(table, ref_id, k) for k in kinds]
                at += len(texts or ())
            width = 4 if rewritten else 3
            columns = list(zip(*rows)) or [()] * width
            kinds_of = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())) if rewritten else (pa.string(), pa.int64(), pa.string())
            names = ["src_table", "ref_id", "kinds", "redacted"] if rewritten else ["src_table", "ref_id", "pii_kind"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds_of)], names=names)

    return run


def records(messages: DataFrame, operations: DataFrame) -> DataFrame:
    """(src_table, ref_id, texts): all texts of each record; a text that stands in it twice comes once."""
    blocks = F.flatten(F.transform(F.coalesce("content", F.array()), lambda b: F.array(b["text"], b["thinking"])))
    chats = messages.select(F.lit("chat_messages").alias("src_table"), F.col("row_id").cast("long").alias("ref_id"), F.array_compact(F.array_distinct(F.concat(F.array("text"), blocks))).alias("texts"))
    files = operations.select(F.lit("file_ops").alias("src_table"), F.col("op_id").cast("long").alias("ref_id"), F.array_compact(F.array("text")).alias("texts"))
    return chats.unionByName(files).filter((F.size("texts") > 0) & F.col("ref_id").isNotNull())


def _run(messages: DataFrame, operations: DataFrame, rewritten: bool, schema: str) -> DataFrame:
    kept = records(messages, operations)
    usual = {**spellings(), **statistics(kept)}
    return kept.mapInArrow(_apply(models(), usual, rewritten), schema)


def found(messages: DataFrame, operations: DataFrame) -> DataFrame:
    """(src_table, ref_id, pii_kind), once for each record and kind. Null and empty texts hold none; repeated rows count once."""
    return _run(messages, operations, False, "src_table string, ref_id long, pii_kind string").distinct()


def redacted(messages: DataFrame, operations: DataFrame) -> DataFrame:
    """(src_table, ref_id, kinds, redacted): the texts of each record that holds something, with placeholders."""
    return _run(messages, operations, True, "src_table string, ref_id long, kinds array<string>, redacted array<string>")
