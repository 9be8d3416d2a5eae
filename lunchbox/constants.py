"""Fixed values of the benefit rules.

These values must equal the behaviour being reproduced (status texts,
category names, title keywords, observation texts, default split).  They are
kept together here, in natural order, as plain text.
"""

# --- fixed values -----------------------------------------------------------
# Job categories and the title keywords that select them (checked in this
# order on the upper-cased title; first match wins, otherwise FUNCIONARIO).
CATEGORY_INTERN = "ESTAGIARIO"
CATEGORY_APPRENTICE = "APRENDIZ"
CATEGORY_DIRECTOR = "DIRETOR"
CATEGORY_EMPLOYEE = "FUNCIONARIO"
DIRECTOR_KEYWORDS = ["DIRETOR", "DIRETORA", "PRESIDENTE", "CEO"]

# Categories removed by the purchase pipeline.
EXCLUDED_CATEGORIES = ["ESTAGIARIO", "APRENDIZ", "DIRETOR"]

# Employee statuses.
STATUS_WORKING = "Trabalhando"
STATUS_VACATION = "Férias"
STATUS_SICK_LEAVE = "Auxílio Doença"
STATUS_MATERNITY = "Licença Maternidade"
STATUS_MEDICAL_NOTE = "Atestado"
EXCLUDED_STATUSES = ["Auxílio Doença", "Licença Maternidade", "Atestado"]

# Exclusion list types.
EXCLUSION_INTERN = "ESTAGIARIO"
EXCLUSION_APPRENTICE = "APRENDIZ"
EXCLUSION_ABROAD = "EXTERIOR"

# Termination notice flag text in the source sheet.
NOTICE_OK_TEXT = "OK"

# Day-of-month limit of the termination-with-notice rule.
NOTICE_DAY_LIMIT = 15

# Observation texts ({} = date as dd/MM/yyyy) and their separator.
NOTE_HIRED = "Admissão em {}"
NOTE_TERMINATED_WITH_NOTICE = "Desligado c/ comunicado até dia 15"
NOTE_TERMINATED_PRORATED = "Desligado em {} (proporcional)"
NOTE_SEPARATOR = "; "

# Default company / employee shares of the benefit.
COMPANY_SHARE = "0.8"
EMPLOYEE_SHARE = "0.2"

# Report labels for the termination rule column (as the report writes them).
REPORT_TERMINATION_PRORATED = "Recebe VR proporcional"
REPORT_TERMINATION_NONE = "Não recebe VR"

# Display headers of the purchase sheet, in output order.
PURCHASE_HEADERS = [
    "MATRICULA", "Admissão", "Sindicato do Colaborador", "Competência", "Dias",
    "VALOR DIÁRIO VR", "TOTAL", "Custo empresa", "Desconto profissional", "OBS GERAL",
]

# Labels of the validation totals.
VALIDATION_LABELS = ["Total colaboradores", "Soma TOTAL", "Soma Custo empresa",
                     "Soma Desconto profissional"]

# Sheet tab name pattern; {} = period label with '/' replaced by '.'.
SHEET_TAB = "VR MENSAL {}"
# ---------------------------------------------------------------------------
