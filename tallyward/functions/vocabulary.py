"""The vocabularies and patterns by which documents are read, as text.

Patterns are Java's: ``(?U)`` gives word boundaries and digits of all scripts.
"""

from __future__ import annotations

import re

from .values import CURRENCY_CODES

CODES = "|".join(CURRENCY_CODES)
#: Codes that may stick to digits or labels; GHC is printed for GHS.
STICKY_CODES = f"{CODES}|GHC"


def words(*phrases: str) -> str:
    """A pattern for any of the phrases as whole words, in any case."""
    return r"(?iU)\b(" + "|".join(phrases) + r")\b"


# Signals of something to pay: name, weight, pattern.
MONEY = r"(?:[$€£]|\bEUR\b|\bUSD\b|\bGBP\b)"
POSITIVE = (
    ("invoice identity pattern", 2, words(r"invoice\s*(no\.?|nr\.?|number|#)", r"rechnung(s)?\s*nr\.?", r"arve\s*nr\.?", r"fatura\s*(no\.?|n[uú]mero)?", r"factura\s*n[uú]mero")),
    ("supplier/buyer block", 1, words(r"bill\s*to", r"sold\s*to", "supplier", "vendor", r"remit\s*to", "lieferant", "rechnungsempf[äa]nger", "m[uü][uü]ja", "ostja", "fornecedor")),
    ("total/subtotal pattern", 1, words(r"sub\s*total", "subtotal", r"total\s*due", r"amount\s*due", r"grand\s*total", "gesamt(betrag)?", "summa", "kokku", r"total\s*a\s*pagar", r"valor\s*total")),
    ("tax/VAT pattern", 1, words("vat", "tax", "k[äa]ibemaks", "mwst", "iva", "steuer")),
    ("currency amount pattern", 1, rf"(?U){MONEY}\s*\d[\d.,]*\d|\d[\d.,]*\d\s*{MONEY}"),
    ("payment terms/due date pattern", 1, words(r"due\s*date", r"payment\s*terms?", r"net\s*\d{1,3}", "f[äa]lligkeitsdatum", "maksetingimused")),
    ("priced line-item table pattern", 1, words("qty", "quantity", r"unit\s*price", "description", "kogus", "hind", "menge", "einzelpreis")),
)
# Signals of a credit and of a reversal.  Letters may stick to a credit's name, if they aren't small.
CREDIT = ("credit note/memo vocabulary", r"(?iU)\b(credit\s*note|credit\s*memo|gutschrift|kreeditarve|nota\s*de\s*cr[ée]dito|nota\s*credito)(?-iU:(?![a-z]))")
REVERSAL = ("reversal/correction reference", words("reverses?", "cancels?", r"correction\s*to", r"referring\s*to\s*invoice", r"in\s*reference\s*to\s*invoice"))
MINUS = ("negative-looking amount", r"(?U)-\s*(?:[$€£]|\bEUR\b|\bUSD\b)?\s*\d[\d.,]*\d|\(\s*\d[\d.,]*\d\s*\)")
# Signals of something else, two points each.
NEGATIVE = (
    ("delivery/waybill vocabulary", words(r"delivery\s*note", r"packing\s*list", "waybill", r"bill\s*of\s*lading", "cmr", "lieferschein", "frachtbrief", "saateleht", r"guia\s*de\s*remessa")),
    ("customs vocabulary", words(r"customs\s*declaration", r"export\s*declaration", "zolldeklaration", "toll(deklarat)?", r"declara[cç][aã]o\s*de\s*exporta[cç][aã]o", r"customs\s*(?:consolidated|detailed)?\s*invoice")),
    ("dunning/reminder vocabulary", words("reminder", "dunning", r"overdue\s*notice", "mahnung", "zahlungserinnerung", "meeldetuletus")),
    ("internal approval/quotation vocabulary", words(r"purchase\s*requisition", r"approval\s*request", r"internal\s*memo", "quotation", "estimate", "angebot", "kostenvoranschlag", "pakkumus")),
)
GOVERNANCE = words(r"donations?\s*and\s*sponsorship", r"sponsorship\s*(?:and|&)\s*donations?", r"charitable\s*contributions?", r"compliance\s*risk", "requestor",
                   r"group\s*cfo", r"group\s*ceo", r"group\s*compliance\s*officer", r"approve\W{0,3}reject", r"reject\W{0,3}approve")
MIN_GOVERNANCE, MIN_EVIDENCE_CHARS = 2, 20

# Where a new document begins.
TITLES = (r"(?iU)\bINVOICE\b|\bRECHNUNG\b|\bFAKTURA\b|\bARVE\b|\bFATURA\b|\bCREDIT\s+NOTE\b|\bCREDIT\s+MEMO\b|\bGUTSCHRIFT\b|\bKREEDITARVE\b|\bNOTA\s+DE\s+CR[ÉE]DITO\b"
          r"|\bDELIVERY\s+NOTE\b|\bLIEFERSCHEIN\b|\bPACKING\s+LIST\b|\bWAYBILL\b|\bBILL\s+OF\s+LADING\b|\bCMR\b|\bCUSTOMS\s+DECLARATION\b|\bEXPORT\s+DECLARATION\b"
          r"|\bPURCHASE\s+ORDER\b|\bQUOTATION\b|\bESTIMATE\b")
IDENTITY = r"(?iU)\b(invoice|document|reference|ref|order|delivery|waybill)\s*(no\.?|nr\.?|number|#)\s*[:\-]?\s*\S+"

# Where recognition sticks a code to digits or a label.
CODE_THEN_DIGIT, DIGIT_THEN_CODE = rf"(?U)\b({STICKY_CODES})(\d)", rf"(?U)(\d)({STICKY_CODES})\b"
LABEL_THEN_CODE = rf"(?iU)\b(total|subtotal|amount|sum)({STICKY_CODES})\b"

# Fields.  Number marks are required after a label, so that a title isn't one.
INVOICE_NUMBER = r"(?iU)\b(?:invoice|rechnung(?:s)?|arve|fatura|factura)\s*(?:no\.?|nr\.?|number|#|n[uú]mero)\s*[:\-]?\s*([A-Za-z0-9][A-Za-z0-9\-/]{1,30})"
LIKE_PHONE, LIKE_DATE = r"(?U)^[+]?\d[\d\s\-]{6,}$", r"(?U)^\d{1,4}[./\-]\d{1,2}[./\-]\d{1,4}$"
ORDER_NUMBER = r"(?iU)\b(?:p\.?\s*o\.?|purchase\s*order|tellimus)(?![A-Za-z])\s*(?:no\.?|number|#)\s*[:\-]?\s*([A-Za-z0-9][A-Za-z0-9\-/]{2,30})"
CODE = rf"(?U)\b({CODES})\b"
SYMBOL = r"(?U)([€£]|\bGHC\b)"
SYMBOLS = {"€": "EUR", "£": "GBP", "GHC": "GHS"}
DATES = r"(?U)\b(\d{4}-\d{2}-\d{2})\b|\b(\d{1,2}\.\d{1,2}\.\d{4})\b|\b(\d{1,2}/\d{1,2}/\d{4})\b"
_DATED = r"\s*[:\-]?\s*(\d{1,4}[./\-]\d{1,2}[./\-]\d{1,4})"
INVOICE_DATE = r"(?iU)\b(?:invoice\s*date|date\s*of\s*issue|rechnungsdatum|kuupäev|kuup(?:ä|a)ev|arve\s*kuup(?:ä|a)ev)\b" + _DATED
DUE_DATE = r"(?iU)\b(?:due\s*date|payment\s*due|maksetähtaeg|maksetahtaeg|f[äa]lligkeitsdatum|vencimento)\b" + _DATED
_NAME = r"\s*[:\-]?\s*\n?\s*([A-Z][A-Za-z0-9&.,\-\s]{2,60}?)(?:\n|$)"
SUPPLIER = r"(?iU)\b(?:supplier|vendor|seller|from|bill\s*from|m[uü][uü]ja|lieferant)" + _NAME
BUYER = r"(?iU)\b(?:buyer|customer|bill\s*to|sold\s*to|ostja|rechnungsempf[äa]nger)" + _NAME
NOT_NAMES = ("ship to", "ship from", "bill to", "bill from", "sold to", "deliver to", "delivery to", "delivery address", "importer of record", "consignee",
             "invoice notes", "shipment information", "invoice information")
#: The same as a pattern: Spark's lower case takes longer than all else that is asked of a name.
NOT_NAME = r"(?i)^(?:" + "|".join(NOT_NAMES) + r")\z"
VAT_ID = r"(?iU)\b(?:VAT\s*Registration|VAT|TAX\s*ID|USt-?ID|KMKR(?:\s*nr\.?)?|Tax\s*Registration)\s*(?:No\.?|Nr\.?|ID)?\s*[:\-]?\s*([A-Z]{2}[A-Z0-9\-]{5,15})"
#: Characters after a buyer's label in which a tax number is the buyer's.
BUYER_REACH = 200
TERMS = r"(?iU)\b(?:payment\s*terms?|terms\s*of\s*payment|tasumistingimus)\s*[:\-]?\s*([A-Za-z0-9 ]{2,30})"
_COIN = rf"[:\s]*(?:[$€£]|\b(?:{CODES})\b)?\s*([\d.,]+)"
TOTAL = r"(?iU)\b(?:grand\s*total|total\s*due|amount\s*due|total|gesamtbetrag|gesamtsumme|endbetrag|kokku|summa|total\s*a\s*pagar)\b" + _COIN
SUBTOTAL = r"(?iU)\b(?:sub\s*total|subtotal|net\s*total|vahesumma)\b" + _COIN
ANY_AMOUNT = rf"(?U){MONEY}\s*([\d.,]+)|([\d.,]+)\s*{MONEY}"
RATED_TAX = r"(?iU)\b(VAT|IVA|MwSt|GST|SST|K[äa]ibemaks|Tax)(?-iU:(?![a-z]))\D{0,10}?(\d{1,2}(?:[.,]\d+)?)\s*%(?:[^\d\n]{0,15}([\d.,]+))?"
TOTAL_TAX = r"(?iU)\bTOTAL\s*(VAT|IVA|MwSt|GST|SST|Tax)(?-iU:(?![a-z]))\s*[:\-]?\s*([\d.,]++)(?!\s*%)"
NET_BASE = r"(?iU)\bsumma\s*km[\s\-]*ta\s*(?:\d{1,2}(?:[.,]\d+)?\s*%)?\D{0,10}?([\-\d.,]+)"
KM_RATE = r"(?iU)\bkm\s*(\d{1,2}(?:[.,]\d+)?)\s*%\D{0,10}?([\-\d.,]+)"

# With which letters, of either case, a match of each pattern begins; of words() the phrases tell.
_FIRSTS = {
    POSITIVE[4][-1]: "$EUG0-9", CREDIT[1]: "cgkn", MINUS[1]: r"\-(", TITLES: "irfacgkndlpwbeq", IDENTITY: "idrow", INVOICE_NUMBER: "iraf", ORDER_NUMBER: "pt", CODE: "".join(sorted({c[0] for c in CURRENCY_CODES})),
    SYMBOL: "G", DATES: "0-9", INVOICE_DATE: "idrka", DUE_DATE: "dpmfv", SUPPLIER: "svfbml", BUYER: "bcsor", VAT_ID: "vtuk", TERMS: "pt", TOTAL: "gtaeks", SUBTOTAL: "snv", ANY_AMOUNT: "$EUG0-9.,",
    CODE_THEN_DIGIT: "".join(sorted({c[0] for c in CURRENCY_CODES})), DIGIT_THEN_CODE: "0-9", LABEL_THEN_CODE: "tsa", RATED_TAX: "vimgskt", TOTAL_TAX: "t", NET_BASE: "s", KM_RATE: "k"}
_WORDS = r"(?iU)\b("


def led(pattern: str) -> str:
    """The same pattern, asked only where a match can begin: at one of its first letters, or at any that isn't ASCII.

    Java takes far longer for a word boundary of all scripts, at each character of a text, than for a set of letters.
    """
    firsts = _FIRSTS.get(pattern)
    if firsts is None:
        phrases = re.sub(r"\([^()]*\)", "", pattern.removeprefix(_WORDS)).split("|")
        if not pattern.startswith(_WORDS) or not all(p[0].isalpha() for p in phrases):
            raise ValueError(f"it isn't known with which letters this begins: {pattern}")
        firsts = "".join(sorted({p[0] for p in phrases}))
    both = firsts + (firsts.swapcase() if firsts.isalpha() else "")
    return rf"(?=[{both}\x80-\x{{10FFFF}}])(?:{pattern})"
