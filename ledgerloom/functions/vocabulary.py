"""Fixed values of gazette documents: words, phrases and patterns that results depend on."""

from __future__ import annotations

# Words that open a published item.
ITEM_TYPES = (
    "ATO DECLARATÓRIO", "ATOS DA DIRETORIA COLEGIADA", "AVISO", "ATA", "CHAMAMENTO", "COMUNICADO", "CONVOCAÇÃO",
    "DECISÃO", "DECLARAÇÃO", "DECRETO", "DESPACHO", "EDITAL", "EXTRATO", "INSTRUÇÃO", "LEI", "JULGAMENTO",
    "NOTIFICAÇÃO", "ORDEM DE SERVIÇO", "PORTARIA", "RECONHECIMENTO DE DÍVIDA", "RECURSO", "RESOLUÇÃO",
    "RESULTADO DE HABILITAÇÃO", "RESULTADO DE LICITAÇÃO", "RETIFICAÇÃO", "TERMO",
)

# Words of an organisation's heading.
ORGANISATION_WORDS = (
    "ADMINISTRAÇÃO", "AGÊNCIA", "ARQUIVO", "CASA CIVIL", "COMPANHIA", "CONSELHO", "BANCO", "CÂMARA", "CONTROLADORIA",
    "COORDENAÇÃO", "CORPO DE BOMBEIROS", "DEFENSORIA", "DEPARTAMENTO", "DIRETORIA", "EMPRESA", "FUNDAÇÃO", "FUNDO",
    "GABINETE", "GERÊNCIA", "HOSPITAL", "INSTITUTO", "POLÍCIA", "PROCURADORIA", "SECRETARIA", "SUBCOMANDO",
    "SUBSECRETARIA", "SUPERINTENDÊNCIA", "TRIBUNAL", "UNIDADE",
)

# Action verbs, in order of the alternatives.
ACTION_VERBS = ("CESSAR OS EFEITOS", "TORNAR SEM EFEITO", "NOMEAR", "EXONERAR", "DESIGNAR", "DISPENSAR", "RETIFICAR")

# Month names.
MONTHS = (
    "JANEIRO", "FEVEREIRO", "MARÇO", "ABRIL", "MAIO", "JUNHO", "JULHO", "AGOSTO", "SETEMBRO", "OUTUBRO", "NOVEMBRO", "DEZEMBRO",
)

# What a person's name or position can't begin with, and headings that are none.
NO_PERSON = ("ORDEM DE SERVIÇO", "PORTARIA", "RESOLUÇÃO", "EDITAL")
NO_POSITION = ("matrícula", "cpf", "processo")
NO_CONTEXT = ("CAPÍTULO ", "TÍTULO ")

# Running lines of an edition.
PUBLICATION_HEADER = "DIÁRIO OFICIAL DO DISTRITO FEDERAL"
IMPRINT = "Redação, Administração e Editoração:"
SECTIONS = ("I", "II", "III")

# Enumerations of the ledger and of annotation batches.
CATEGORIES = (
    "noise", "summary", "front_matter", "publication_header", "publication_metadata", "section_heading", "editorial_context", "published_item",
)
JUDGMENTS = {
    "observation": ("PRESENT", "AMBIGUOUS"),
    "evaluation": ("CONFIRMED", "REJECTED", "MISSING", "AMBIGUOUS", "NOT_APPLICABLE"),
    "identity_decision": ("SAME_ENTITY", "DISTINCT_ENTITIES", "UNRESOLVED"),
    "adjudication": (
        "CONFIRMED", "REJECTED", "MISSING", "AMBIGUOUS", "NOT_APPLICABLE", "SAME_ENTITY", "DISTINCT_ENTITIES", "UNRESOLVED",
    ),
}

# Patterns, in Java's dialect. (?U): letters and spaces of all scripts. What stands before a \b in (?=...) is how
# the words behind it begin, so that the dear \b is looked at in few places; it changes no match.
_first = lambda words: "".join(sorted({w[0] for w in words}))
SPACED_VERBS = "|".join(v.replace(" ", r"\s+") for v in ACTION_VERBS)
PATTERNS = {
    "processo_sei": r"(?U)(?=\d)\b\d{5}\s*-\s*\d{8}\s*/\s*\d{4}\s*-\s*\d{2}\b",
    "cnpj": r"(?U)(?=\d)\b\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\b",
    "monetary_value": r"(?U)R\$\s*[\d.]+,\d{2}",
    "norm": r"(?iU)(?=[DLPR])\b(?:DECRETO|LEI|PORTARIA|RESOLUÇÃO)\s+(?:N[º°o]?\s*)?[\d.]+(?:/\d{4})?",
    "article": r"(?iU)(?=A)\bArt\.?\s*\d+[º°o]?",
    "action": rf"(?iU)(?=[{_first(ACTION_VERBS)}])\b(?:{SPACED_VERBS})\b",
}
SECTION = r"(?iU)^SEÇÃO\s+(I|II|III)$"
ANY_SECTION = r"(?iU)^SE[CÇ][AÃ]O\s+[IVXLCDM]+$"
ITEM_TYPE = rf"(?iU)^({'|'.join(ITEM_TYPES)})\b"
ORGANISATION = rf"(?iU)(?=[{_first(ORGANISATION_WORDS)}])\b(?:{'|'.join(ORGANISATION_WORDS)})\b"
ITEM_NUMBER = r"(?iU)\bN[º°o]?\s*([\w./-]+)"
ITEM_DATE = r"(?iU)\bDE\s+(\d{1,2})\s+DE\s+([A-ZÇ]+)\s+DE\s+(\d{4})"
NAME_LETTERS = "A-ZÁÀÂÃÉÊÍÓÔÕÚÜÇ"
PERSON = rf"(?iU)^(\s*,?\s*(?:(?:A PEDIDO|POR MOTIVO DE APOSENTADORIA)\s*,?\s+)?)([{NAME_LETTERS}][{NAME_LETTERS}\s]{{2,118}}?)(?=,)"
PAGE_NUMBER = r"(?iU)^(?:pagina\s+)?\d+$"
RUNNING_HEADER = r"(?iU)^P[AÁ]GINA\s+\d+\s+Di[aá]rio Oficial do Distrito Federal\b"
EDITION_FILE = r"(?iU)^DODF\s+(\d+)\s+(\d{2})-(\d{2})-(\d{4})(?:\s+(.+))?$"
EDITION_KEY, EDITION_WORD = "dodf", "edicao"
