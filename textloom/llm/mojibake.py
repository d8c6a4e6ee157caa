"""Problem 1: text garbled by a wrong character encoding.

Method: minimum description length. A line is cut into words; for every chain of
encodings (the bytes were written in one and read in another, once or twice) the
longest stretches of words that the chain can turn back are candidates. A
candidate's length is what zstandard makes of it with the best of several
per-language dictionaries, plus the cost of its chain; as found, the stretch costs
its own compressed length. Stretches are restored where that is shorter, the
largest saving first, otherwise the text is left unchanged. Foreign words, signs
and scripts save nothing when re-read, so they stay.

The Turkish dictionary is fitted on a bounded sample of the lines themselves
(``SAMPLE`` lines without any unusual character, chosen by a hash of their id);
those of the other languages are a few public sentences each, since the table has no
lines in them to learn from. A restored word must be one that some language can
write, with letters of its alphabet alone, and a stretch is in one language.

Characters lost for good (U+FFFD) can't be restored by any chain. Lines that have
them are reported by this second rule, with their number.

Defined results: null, empty and blank texts are left out; repeated rows with one
id and text give one row; a table without usable sample lines falls back to the
fixed sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 6000
DICT_BYTES = 112_640
LEVEL = 12

# Characters that need no second look in Turkish text.
USUAL = "\\x00-\\x7FçğıöşüÇĞİÖŞÜâîûÂÎÛ’‘“”…–—•"
UNUSUAL = f"[^{USUAL}\\u00a0\\u2000-\\u200f\\u3000\\ufeff]|(?<=\\p{{L}})”(?=\\p{{L}})|Â\\u00a0"

# Chains of (written in, read in) steps, last step first undone, and their cost in bytes.
CHAINS: list[tuple[str, list[tuple[str, str]], float]] = [
    ("utf-8 as cp1252", [("cp1252", "utf-8")], 1.0),
    ("utf-8 as latin-1", [("latin-1", "utf-8")], 1.0),
    ("utf-8 as cp1254", [("cp1254", "utf-8")], 1.0),
    ("utf-8 as cp437", [("cp437", "utf-8")], 1.5),
    ("utf-8 as cp850", [("cp850", "utf-8")], 1.5),
    ("utf-8 as cp857", [("cp857", "utf-8")], 1.5),
    ("utf-8 as cp866", [("cp866", "utf-8")], 2.0),
    ("utf-8 as cp1251", [("cp1251", "utf-8")], 2.0),
    ("utf-8 as cp1250", [("cp1250", "utf-8")], 2.0),
    ("utf-8 as cp1253", [("cp1253", "utf-8")], 2.0),
    ("utf-8 as mac-roman", [("mac_roman", "utf-8")], 2.0),
    ("utf-8 as cp1252, lower case", [("lower", ""), ("cp1252", "utf-8")], 2.0),
    *((f"utf-8 as {a}, then as {b}" if a != b else f"utf-8 as {a}, twice", [(b, "utf-8"), (a, "utf-8")], 2.0 if a == b else 2.5) for a in ("cp1252", "latin-1", "cp1254") for b in ("cp1252", "latin-1", "cp1254")),
    ("cp1254 as latin-1", [("latin-1", "cp1254")], 2.5),
    ("cp1254 as cp1252", [("cp1252", "cp1254")], 2.5),
    ("cp1254 as cp1251", [("cp1251", "cp1254")], 2.5),
    ("cp1254 as cp1250", [("cp1250", "cp1254")], 3.0),
    ("cp1254 as cp1253", [("cp1253", "cp1254")], 3.0),
    ("cp857 as cp1252", [("cp1252", "cp857")], 2.5),
    ("cp857 as cp1254", [("cp1254", "cp857")], 2.5),
    ("cp857 as latin-1", [("latin-1", "cp857")], 2.5),
    ("cp1254 as cp857", [("cp857", "cp1254")], 3.0),
    ("cp1254 as cp437", [("cp437", "cp1254")], 3.0),
]

# Plain sentences of each language, among them the first and third articles of the Universal Declaration of Human Rights.
SENTENCES = {
    "en": "The quick reader asks what the weather will be like and whether the house on the corner is still for sale; they would have been there before. All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. Everyone has the right to life, liberty and security of person. ",
    "de": "Die Größe der Straße ändert sich nicht, und über die Brücke fährt heute kein Zug; schöne Grüße aus München, wir möchten später noch kommen. Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen. Jeder hat das Recht auf Leben, Freiheit und Sicherheit der Person. ",
    "fr": "Où est passé l'élève qui a déjà vu cette pièce à Noël ? Il a été reçu à l'école française, c'était très naïf de sa part, voilà tout. Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. Tout individu a droit à la vie, à la liberté et à la sûreté de sa personne. ",
    "es": "¿Qué tal el año? El niño pequeño mañana vendrá a la montaña con más señales, ¡qué corazón tan grande! También habrá música española. Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. Todo individuo tiene derecho a la vida, a la libertad y a la seguridad de su persona. ",
    "pt": "São Tomé não é tão longe; amanhã as ações e as canções começam às três da manhã, então você também irá à estação do João. Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade. Todo o indivíduo tem direito à vida, à liberdade e à segurança pessoal. ",
    "it": "Perché la città è così bella di sera, e più tardi verrà anche lui al caffè. Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. ",
    "pl": "Łódź jest piękna, a źródło rzeki leży daleko; więc proszę, żeby się nie śmiać z tej książki, którą wczoraj czytał mój mąż. Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek ma prawo do życia, wolności i bezpieczeństwa swej osoby. ",
    "cs": "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství. ",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek. ",
    "ro": "Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință și trebuie să se comporte unele față de altele în spiritul fraternității. ",
    "nordic": "Smørrebrød på Ærø smager godt, og Ångström var fra Sverige; Þórsmörk er fallegur dalur og það er gott að búa í Reykjavík við ströndina. Alle mennesker er født frie og lige i værdighed og rettigheder. De er udstyret med fornuft og samvittighed. Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete. ",
    "ru": "Привет, как дела? Сегодня хорошая погода, и мы пойдём гулять по городу, а потом будем читать книгу о том, что было раньше. Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства. Каждый человек имеет право на жизнь, на свободу и на личную неприкосновенность. ",
    "tr": "Öğleden sonra yağmur yağınca çocuklar eve döndü; akşama doğru güneş açtı, bütün komşular bahçeye çıkıp uzun süre konuştular. İki gün önce Şirket çalışanları için öğle yemeği düzenlenmişti. Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. ",
}

LOWERED = str.maketrans("ãäåÿ", "ÃÄÅŸ")
SPLIT = re.compile("([ \\t\\n\\r\\x0b\\x0c\u2000-\u200b\u3000\ufeff]+|(?<![ÂÃ])\u00a0+)")
ODD = re.compile(f"[^{USUAL}]|(?<=[^\\W\\d_])”(?=[^\\W\\d_])")
# The letters of each language beyond a to z, and the signs that only it has.
ALPHABETS = {
    "tr": "çğıöşüâîû", "de": "äöüß", "fr": "àâæçéèêëîïôœùûüÿ", "es": "áéíñóúü¿¡", "pt": "ãâáàçéêíõôóúü", "it": "àèéìîòóù", "pl": "ąćęłńóśźż", "cs": "áčďéěíňóřšťúůýž", "hu": "áéíóöőúüű", "ro": "ăâîșțşţ",
    "sv": "åäöé", "da": "æøåé", "is": "áéíóúýðþæö", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюяё",
}
# What restored words may consist of: plain characters and signs, and the letters of one language.
KNOWN = [re.compile(f"[\\x00-\\x7F’‘“”…–—•«»·°€½§©®\u00a0{a}{a.upper().replace('SS', '')}İ]*") for a in ALPHABETS.values()]
ANY = (1 << len(KNOWN)) - 1
SCHEMA = "id bigint, text string, restored string, chains array<string>, stretches int, lost int"


@lru_cache(maxsize=64)
def forward_table(encoding: str) -> list[str]:
    """The character of every byte; bytes that the encoding leaves open are read as control characters, as browsers do."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(maxsize=64)
def reverse_table(encoding: str) -> dict[str, int]:
    """The byte of every character."""
    return {c: b for b, c in enumerate(forward_table(encoding))}


def undo(text: str, steps: list[tuple[str, str]]) -> str | None:
    """The text before it went through the chain; null where it can't have."""
    for read, written in steps:
        if read == "lower":
            text = text.translate(LOWERED)
            continue
        back = reverse_table(read)
        try:
            raw = bytes([back[c] for c in text])
        except KeyError:
            return None
        if written == "utf-8":
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                return None
        else:
            table = forward_table(written)
            text = "".join([table[b] for b in raw])
    return text


@lru_cache(maxsize=100_000)
def written_in(word: str) -> int:
    """The languages that can write a word, as bits."""
    return sum(1 << k for k, x in enumerate(KNOWN) if x.fullmatch(word))


class Describer:
    """Compressed lengths under the best of several dictionaries."""

    def __init__(self, sample: bytes) -> None:
        self.tools = []
        for lang, sentence in SENTENCES.items():
            data = sentence.encode() + (sample if lang == "tr" else b"")
            d = zstandard.ZstdCompressionDict(data[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.known: dict[str, int] = {}

    def length(self, text: str) -> int:
        n = self.known.get(text)
        if n is None:
            if len(self.known) > 100_000:
                self.known.clear()
            raw = text.encode("utf-8", "replace")
            n = self.known[text] = min(len(t.compress(raw)) for t in self.tools)
        return n


def restore(text: str, describer: Describer) -> tuple[str, list[str], int, int]:
    """(restored text, chains used, stretches restored, characters lost)."""
    parts = SPLIT.split(text)
    words = parts[::2]
    odd = [bool(ODD.search(w)) for w in words]
    options = []
    for name, steps, cost in CHAINS:
        out: list[str | None] = []
        can: list[int] = []
        for w, o in zip(words, odd):
            if w.isascii() and not o:
                out.append(w)
                can.append(ANY)
                continue
            v = undo(w, steps)
            # A word that the chain leaves as it is doesn't end a stretch.
            can.append(0 if v is None else ANY if v == w else written_in(v))
            out.append(v if can[-1] else None)
        i = 0
        while i < len(words):
            if out[i] is None or out[i] == words[i]:
                i += 1
                continue
            j = last = i
            languages = ANY
            # All words of a stretch are of one language.
            while j < len(words) and languages & can[j]:
                languages &= can[j]
                if out[j] != words[j]:
                    last = j
                j += 1
            if any(odd[i : last + 1]):
                before = "".join(parts[2 * i : 2 * last + 1])
                after = "".join(x if k % 2 else out[i + k // 2] for k, x in enumerate(parts[2 * i : 2 * last + 1]))
                saved = describer.length(before) - describer.length(after)
                if saved >= 0:
                    options.append((saved, saved - cost, name, i, last, after))
            i = j
    taken: list[tuple[int, int, str]] = []
    chains = []
    options.sort(key=lambda x: (-x[1], x[3] - x[4], x[2], x[3]))
    for known in (False, True):
        # A chain that the line has paid for once costs nothing for its other stretches.
        for saved, gain, name, i, last, after in options:
            if (gain > 0 or (known and name in chains)) and all(last < a or b < i for a, b, _ in taken):
                taken.append((i, last, after))
                chains.append(name)
    pieces, at = [], 0
    for i, last, after in sorted(taken):
        pieces += [*parts[2 * at : 2 * i], after]
        if last + 1 < len(words):
            pieces.append(parts[2 * last + 1])
        at = last + 1
    pieces += parts[2 * at :]
    return "".join(pieces), sorted(set(chains)), len(taken), text.count("�")


def dictionary_sample(df: DataFrame, id_col: str, text_col: str, sample: int) -> bytes:
    """A bounded sample of lines without unusual characters, the same for the same table.

    Rows are drawn by a hash of their id at a rate that gives about four times
    the sample, so at any size only so many reach the final choice.
    """
    text = F.col(text_col)
    rate = min(1.0, 4 * sample / max(1, df.count()))
    lines = df.select(F.col(id_col).alias("id"), text.alias("text")).where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(rate * (1 << 30)))
    lines = lines.where(text.isNotNull() & ~text.rlike(f"[^{USUAL}]") & text.rlike("[çğıöşü]") & (F.length(text) >= 20) & (F.length(text) <= 2000))
    rows = lines.orderBy(F.xxhash64("id"), "id", "text").limit(sample).select("text").collect()
    return " ".join(r.text for r in rows).encode()


def repair(df: DataFrame, id_col: str = "line_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, text, restored, chains, stretches, lost) of the affected lines, restored as far as possible."""
    sent = df.sparkSession.sparkContext.broadcast(dictionary_sample(df, id_col, text_col, sample))
    text = F.col(text_col)
    lines = df.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).where(F.col(id_col).isNotNull() & text.rlike(UNUSUAL))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = Describer(sent.value)
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fixed, chains, n, lost = restore(t, describer)
                if n or lost:
                    rows.append((i, t, fixed, chains, n, lost))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return lines.mapInArrow(of, SCHEMA)


def found(df: DataFrame, id_col: str = "line_id", text_col: str = "text") -> DataFrame:
    return repair(df, id_col, text_col).select(F.col("id").alias("line_id")).distinct()
