"""Word lists, codes and patterns that results depend on, stated as plain text."""

# The module prefixes of program codes.
MODULES = (
    "FATU", "ESTO", "PEDI", "ADMI", "EPRO", "CFAB", "MPSP", "COMP", "VEND", "PREC", "CEXC", "RECE", "MIND",
    "CEXT", "CPRO", "CPAG", "FVEN", "TERC", "CREC", "CUST", "FPAG", "CONT", "RHUM", "CLAB", "LFIS",
)

# Sizes of chunks in characters.
MAX_CHARS, TOPIC_MAX, MIN_CHARS, OVERLAP, CAPTION_MAX = 2400, 6000, 400, 200, 8000

# Patterns of the documents' structure.
CODE = r"\b([A-Z]{3,5})(\d{1,4})\b"
MESSAGE_CODE = r"\b(?:KND|ORA)-\s?\d+"
MESSAGE = r"\b((?:KND|ORA)-\s?\d+)(?:\s*(?::|\s-)\s*([^\n\]]{1,200}?)(?=\s*(?:\n|\]|\d\.\s|$)))?"
SEPARATOR = r"X{15,}x?"
RECORD_START = (
    r"^(?=(?:Desenvolvido\s+(?:pelo\s+)?)?Pedido\s+(?:de\s+)?Servi[çc]o(?:\s*:\s*\d+|\s+\d+\s*(?::|Solicita|Cliente))"
    r"|De:\s.+|E-mail —|Testes feitos)"
)
LABEL = r"^(?=(?:Solicita[çc][ãa]o|Solicitado|Detalhamento|Observa[çc][ãa]o|Situa[çc][õo]es|Rotina|Documenta[çc][ãa]o)\s*:)"
OUTLINE = r"(?:(?<=\s)|^)(\d{1,2}(?:\.\d{1,2}){0,4})(?:[.)]\s+(?=[A-ZÁÉÍÓÚÂÊÔÃÕÇ\"“])|\s?=\s*(?=[^\s=\d]))"
REQUEST = r"Pedido\s+(?:de\s+)?Servi[çc]o:?\s*(\d+)"
SENTENCE_GAP = r"(?<=[.!?:;])\s+"
IMAGE = r"\[Imagem:[^\]]*\]"
MARKER = r"\[(?:Imagem|Código):[^\]]*\]"
CODE_MARKER = r"\[Código: ([^\]]*)\]"
IMAGE_REFERENCE = r"\[Imagem: ([^\]]*)\]"
CONTENTS_LINE = r"^.*\.{5,}.*$"
TITLE_END = r"\s\d{1,2}\.\d{1,2}[.)]\s|\n"
TITLE_NUMBER = r"^\d{1,2}\s?[.)=]\s*"
FILE_ENDING = r"(?i)\.(?:pdf|docx)$"
MAIL_MARK = r"^E-mail —(?: Assunto:)?"
MAIL_STARTS = ("De:", "E-mail —")
NO_SUBSTANCE = r"\W"
CAPTION_TAIL = r"(?:\A|(?<=\n\n))(?:(?!\n\n)[^\[\]]){0,1499}\]"
CAPTION_LINE = r"(?m)^(?:(?!\n\n)[.\s])*(?:\d\.\s*)?(?:A imagem|Nenhum código)\b.*$"

# What the last step of cleaning replaces, in this order: page filler, markers on lines
# of their own, images named twice in a row, blank lines.
TIDY = (
    (r"(?im)^[ \t]*z{8,}[^\n]*?(?=\S|$)", ""),
    (r"\s*\n\s*(\[Código: [^\]]*\])", r" \1"),
    (r"(\[Imagem: [^\]]*\])(\s*\1)+", r"\1"),
    (r"\s*\n\s*(\[Imagem: [^\]]*\])", r" \1"),
    (r"\n{3,}", "\n\n"),
)

# Patterns of e-mail noise.
MAIL_FIELDS = "De|From|Enviada em|Enviado em|Enviado el|Enviado|Sent|Date|Data|Para|To|Cc|CC|Cco|Bcc|Importância|Importance|Assunto|Subject|Asunto"
MAIL_HEADER = r"^[ \t]*(?:De|From)[ \t]*:[^\n]*?(?:\n[^\n]*?){0,6}?(?:Assunto|Subject|Asunto)[ \t]*:[ \t]*([^\n]*)"
MAIL_HEADER_PROOF = r"(?:Enviad[ao]|Sent|Para|To|Cc|Date|Data)\s*:"
MAIL_HEADER_BARE = rf"^[ \t]*(?:De|From)[ \t]*:[^\n]*\n(?:[ \t]*(?:{MAIL_FIELDS})[ \t]*:[^\n]*\n?)+"
MAIL_REPLY_PREFIX = r"^(?:(?:RE|RES|ENC|FW|FWD|TR|RV)\s*:\s*)+"
MAIL_LINK = r"\[mailto:[^\]]*\]"
MAIL_FORWARD = r"^[ \t]*-{3,}\s*(?:Mensagem encaminhada|Forwarded message|Mensaje reenviado|Original Message|Mensagem original)\s*-{3,}[ \t]*"
MAIL_QUOTE_INTRO = r"^[ \t]*(?:Em|On|El)\s.{5,80}?(?:escreveu|wrote|escribió)\s*:[ \t]*$"
MAIL_GREETING = (
    r"^[ \t]*(?:Bom dia|Boa tarde|Boa noite|Olá|Ola|Oi|Prezad[oa]s?|Buen(?:os)? d[ií]as?|Buenas tardes|Hola|Hi|Hello)\b[^\n.]{0,40}[,!]?[ \t]*$"
)
MAIL_CLOSING = (
    r"^[ \t]*(?:Att\.?|Atte\.?|Atenciosamente|Abra[çc]os?|Abs\.?|Saludos(?: cordiales)?|Cordialmente|Obrigad[oa]|Grat[oa]|Regards|Best regards)[,.!]?[ \t]*\n"
    r"(?:[ \t]*[^\n.:;]{1,60}[ \t]*(?:\n|$)){0,5}"
)
MAIL_PHONE = r"^[ \t]*(?:Tel|Fone|Telefone|Cel|Celular|Phone|Whats(?:app)?)\.?[ \t]*:?[ \t]*[+()\d][\d ()+.-]{6,}.*$"
MAIL_SITE = r"^[ \t]*(?:www\.\S+|\S+@\S+\.\S+)[ \t]*$"
# What is replaced in e-mails once their headers are, in this order.
MAIL_NOISE = (
    ("(?m)" + MAIL_HEADER_BARE, "E-mail —\n"), (MAIL_LINK, ""), ("(?im)" + MAIL_FORWARD, ""), ("(?im)" + MAIL_QUOTE_INTRO, ""),
    ("(?im)" + MAIL_GREETING, ""), ("(?im)" + MAIL_CLOSING, "\n"), ("(?im)" + MAIL_PHONE, ""), ("(?m)" + MAIL_SITE, ""),
)

# Patterns of SQL and PL/SQL lines.
SQL_START = (
    r"\b(?:SELECT\b[^\n]*?\bFROM\b|SELECT\s*$|INSERT\s+INTO\b|UPDATE\s+[\w.]+\s*(?:\w+\s*)?(?:SET\b|$)|DELETE\s+FROM\b|"
    r"DECLARE\b|CREATE\s+OR\s+REPLACE\b|CREATE\s+(?:TABLE|INDEX|VIEW)\b|ALTER\s+TABLE\b|CURSOR\s+\w+\s+IS\b|"
    r"BEGIN\s*$|PROCEDURE\s+\w+\s*[(;]|FUNCTION\s+\w+\s*\()"
)
SQL_GO_ON = (
    r"^\s*(?:WHERE|AND|OR|FROM|JOIN|INNER|LEFT|RIGHT|OUTER|FULL|ON|GROUP\s+BY|ORDER\s+BY|HAVING|CONNECT\s+BY|"
    r"START\s+WITH|SET|VALUES|INTO|OPEN|FETCH|CLOSE|LOOP|EXIT|END|IF|ELSE|ELSIF|THEN|COMMIT|ROLLBACK|EXCEPTION|"
    r"BEGIN|RETURN|UNION|CASE|WHEN|SELECT|NVL|DECODE|TO_CHAR|TO_DATE|SUM|COUNT|MAX|MIN|DISTINCT|AS|IS|NOT|"
    r"EXISTS|IN|NULL|FOR|WHILE|RAISE\w*|DBMS_\w+|--|/\*|\*/|\)|\(|,)(?=\W|$)"
)
SQL_TABLE = r"\b(?:FROM|JOIN|INTO|UPDATE|TABLE)\s+([A-Za-z_][\w$#]*(?:\.[A-Za-z_][\w$#]*)?)"
SQL_ATTRIBUTE = r"%(?:ROWTYPE|TYPE|NOTFOUND|FOUND)\b"
SQL_SELECT_WORD = r"\s*(SELECT\b)(?!\s+(?:de|do|da|deste|desta|para|que|com)\b)"
SQL_ASSIGNMENT = r":="
SQL_STATEMENT_END = r"[=():].*;$"
WORDS_IN_A_ROW = r"[a-zà-ú]{4,} [a-zà-ú]{4,} [a-zà-ú]{4,}"
LEAST_LETTERS = 0.55
SQL_NOT_TABLES = ("select", "set", "where", "dual", "values", "the", "exists", "table", "c_dados")

# Stop words of key phrases and words that every procedure has.
PHRASE_STOP = """
a à ao aos as às até após com como da das de do dos e é em entre era essa esse esta este estes estas eu foi foram há isso isto
já la lhe mais mas me mesmo na nas nem no nos não o os ou para pela pelas pelo pelos por qual quando que quem se sem ser seu
seus sua suas são só também te tem ter um uma umas uns você vai será sendo estar está estão pode podem deve devem deverá foi
sobre cada todo toda todos todas outro outra outros outras onde então ainda assim caso bem nesta neste nesse nessa desta deste
dessa desse aqui ali lá seja sejam fica ficar feito feita fazer faz dia el la los las del por con para una uno que en y o se al
lo su sus es
"""
PHRASE_BOILERPLATE = """
campo campos tecle clique clicar botão botões lista listas valores valor tela telas programa programas posicionar
posicionar-se informar informe localizar desejado desejada desejados efetuar clics clic sobre selecionar selecionada selecionado
abrir aberta aberto fechar voltará inicial aba abas opção opções registro registros salvar sugerido sugerida sugestão pedido
serviço solicitação detalhamento observação imagem conforme abaixo acima segue seguinte teste testes testado ok sim cliente
favor obrigado obrigada att atenciosamente tendo informação código códigos diretamente modo entrar navegue navegar
barra ferramentas superior inferior esquerda direita param confirmar consulta consultar executar retornar automaticamente caso
contrário processo após antes agora abaixo necessário conseguir
"""
# Stop words of cluster keywords and TF-IDF vectors.
CLUSTER_STOP = """
a à ao aos as até com como da das de do dos e é em entre essa esse esta este foi há isso já mais mas na nas não no nos o os ou
para pela pelo por que se sem ser seu sua são também tem um uma el la los las del con y lo su es campo tecle clique botão lista
valores tela programa posicionar informar localizar desejado desejada efetuar selecionar abrir aba opção registro salvar pedido
serviço solicitação imagem cliente tipo tópico pdf docx documentacao
"""
