"""Signs, words and messages that results depend on, plainly, and the patterns built of them."""

from __future__ import annotations

import re

# Makers and programs of scans, anywhere in a creator's or producer's name in lower case
SCANNERS = (
    "scanner", "scan", "epson", "hp scanjet", "canon", "fujitsu", "kodak", "brother", "xerox", "lexmark", "kmc", "kofax", "ricoh",
    "iris", "capturedocument", "paperport", "readiris", "simpleocr",
)

# What extraction logs say of damaged files
CORRUPT_LOGS = (
    "format error: object out of range", "syntax error: no XObject subtype specified", "syntax error: syntax error in content stream", "object is not a stream",
    "syntax error: syntax error in array", "format error: cannot load page tree", "syntax error: cannot parse indirect object",
)

# List marks that become -, * and [x]
DASH_MARKS = "‣⁃►▶▸➤➢›▪▫●○"
STAR_MARKS = "•·°◌∙◦●"
CHECK_MARKS = "✓✔✗✘"

# Signs that are no line of their own; control characters but the line feed among them
LONE_SIGNS = "\"!”:【，】；“„';∶`．？！：〉,&?。…."
TERMINAL_SIGNS = (
    "᪩?⁈꩞﹗፧𑅂꡶⁉࠾᪨𑊩𑱂᱿𖩮᥅﹒𑈹𑈸܂؞꛳𑗍𐩖꩟᠉𑗗᰼𑻸؟𑪜꧉𑗉𐽙𖫵𖬷܀꓿᜵𑗏𑁇𑗓𑥄៖𑥆𑗑𑗒꯫۔𐩗꡷｡៕߹⸮.𑇅࠹𛲟꫰꤯𐽗᭞𑜼፨𑃁꣏𑇟𖬸𑜾࠷"
    "?𑃀𑗃！։꣎॥𑗖᭛᠃!၊𖺘⁇𑗌𑑋𖭄᭟𑅁𑙁⸼꩝𑗋。꧈꫱𑜽𐽖𑂿᙮។꛷៚᥄𑗕𑗎᪪᭚࠽𑇞𑗊𐽘𑗔𖩯𑇍𑻷𐽕𑩃।𑗂𑇆𑁈။᱾𑱁꘏܁᜶‼𑈻‽᪫﹖𑑌𑈼𑗐៙᰻"
)
CONTROLS = "".join(map(chr, [*range(9), *range(11, 32), *range(127, 160)]))

# Words before a page number, and what stands between it and the number of pages, by language
PAGE_WORDS = """
en Page p pp : of
zh 页 : 的
hi पृष्ठ पेज : का से
es Página Pág : de
fr Page p : sur de
ar صفحة : من
bn পৃষ্ঠা পাতা : এর
ru Страница Стр : из
pt Página Pág : de
id Halaman Hal : dari
ur صفحہ : کا
de Seite S : von
ja ページ P : の
sw Ukurasa Uk : wa
mr पान पृष्ठ : चे
te పేజీ పుట : లో
tr Sayfa S : den
ta பக்கம் பக் : இல்
vi Trang Tr : của
ko 페이지 쪽 : 의
it Pagina Pag : di
th หน้า : ของ
gu પાનું પેજ : નું
pl Strona Str : z
uk Сторінка Стор : з
kn ಪುಟ ಪೇಜ್ : ರ
ml പേജ് താൾ : ന്റെ
or ପୃଷ୍ଠା ପେଜ୍ : ର
pa ਪੰਨਾ ਪੇਜ : ਦਾ
ro Pagina Pag : din
nl Pagina Pag p : van
hu oldal o : ból
el Σελίδα Σελ : από
cs Strana Str : z
be Старонка Стар : з
he עמוד עמ : מתוך
sv Sida S : av
az Səhifə Səh : dan
bg Страница Стр : от
ms Muka_surat Ms : daripada
uz Sahifa Sah : dan
ne पृष्ठ पेज : को
si පිටුව පි : හි
kk Бет Б : дан
am ገጽ : ከ
ka გვერდი გვ : დან
no Side S : av
da Side S : af
fi Sivu S : ja
sk Stránka Str : z
hr Stranica Str : od
"""
# Wordings of their own; # is a page number, blanks may be missing
PAGE_FORMS = (
    "#", "# / #", "第 # 页", "第 # 页 / #", "第 # 页 共 # 页", "第 # 頁", "第 # 頁 / #", "# ページ", "# ページ / #", "# / # ページ", "P. #", "# 페이지", "# 페이지 / #", "# / # 페이지", "# 쪽",
    "#. oldal", "#. oldal / #", "# صفحة", "# صفحہ", "หน้า #", "หน้า # / #", "עמוד #", "עמ' #",
)


def page_words() -> dict[str, set[str]]:
    """Connectors of each page word, over all languages that have it."""
    out: dict[str, set[str]] = {}
    for line in PAGE_WORDS.strip().splitlines():
        names, _, between = line.partition(" : ")
        for w in names.split()[1:]:
            out.setdefault(w.replace("_", " "), {"of"}).update(between.split())
    return out


def page_number_pattern() -> str:
    """One pattern of all wordings of a page number, for texts without white space at their ends; case is ignored."""
    n = r"(?:0|[1-9][0-9]{0,3})"
    forms = [re.escape(f).replace(r"\#", n).replace(r"\ ", r"\s*") for f in PAGE_FORMS]
    by_rule: dict[tuple[str, str], list[str]] = {}
    for word, between in page_words().items():
        blank = "*" if len(word) <= 2 or word.islower() else "+"
        by_rule.setdefault((blank, "|".join(sorted(between))), []).append(re.escape(word))
    for (blank, between), words in by_rule.items():
        forms.append(rf"(?:{'|'.join(words)})(?:\s{blank}{n}(?:\s*/\s*{n}|\s*{n}[a-z/]{n}|\s+(?:{between})\s+{n})?|:\s*{n}(?:\s*/\s*{n})?)")
    return "^(?:" + "|".join(forms) + ")$"


def mark_patterns() -> list[tuple[str, str]]:
    """(pattern, what it becomes) of list marks at the start of an item, in the order of use."""
    dash = "|".join(rf"\s*[{c}-](?:\s+{c})*" for c in DASH_MARKS)
    return [(rf"^(?:\s*[{CHECK_MARKS}])", "[x]"), (rf"^(?:\s*[{STAR_MARKS}])", "*"), (rf"^(?:{dash})", "-")]
