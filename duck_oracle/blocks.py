"""Building blocks of the oracle statements: labels as tables, winners as aggregates.

The statements follow the written specification of each report, not the Spark
code: the one row of a key is an aggregate over whole rows (``newest`` /
``lowest``: DuckDB's ``arg_max`` / ``arg_min`` over a struct, where a null
ranks above every value), dictionary texts and status lists are scalar
subqueries, and fixed labels are small tables or lists that are looked up.
"""
from __future__ import annotations

import datetime as dt

# Fixed values of the specification.
STORES = ("D005", "D090", "D007", "D002", "D123", "D071")
WAREHOUSE_NO = "OURO"
NOT_STOCKED = "Item não estocável"
PHASE_NAMES = ("0 - Criada / Aberta", "1 - Liberada", "2 - Concluída Tecnicamente", "3 - Encerrada Comercial")
KINDS = ((1, "PRP", "prep", "Preparação"), (2, "OFI", "ofi", "Oficina"))
ACCOUNT_NAMES = (("K", "Centro de Custo"), ("A", "Ativo Fixo (Imobilizado)"), ("F", "Ordem (Manutencao/Interna)"),
                 ("P", "Projeto (PEP)"), ("Q", "Projeto (PEP)"), ("N", "Rede"), ("", "Estoque"))
DESTINATIONS = (("", "estoque"), ("K", "centro_custo"))
APPROVAL_NAMES = (("STARTED", "1. Iniciado/Aguardando"), ("READY", "2. Pronto para Aprovacao"),
                  ("COMPLETED", "3. Aprovado"), ("CANCELLED", "0. Cancelado/Reprovado"))
MOVES = (("201", "Reserva Manual"), ("261", "Ordem"))
PAID = ("Não Lançado", "Pago / Fatura Lançada (MIRO)")
RECEIVED = ("MIGO PENDENTE", "MIGO FEITA")


def text(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def one_of(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def table(rows, *names: str) -> str:
    body = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else text(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS fixed({', '.join(names)})"


def named(code: str, rows, otherwise: str) -> str:
    """Label of a code from fixed rows (code, label)."""
    keys, labels = zip(*rows)
    at = f"list_position([{', '.join(map(text, keys))}], {code})"
    return f"coalesce(list_extract([{', '.join(map(text, labels))}], {at}), {otherwise})"


def chosen(labels, *conditions: str) -> str:
    """The label of the first condition that holds; the last label if none does."""
    tests = ", ".join(f"coalesce({c}, false)" for c in conditions)
    return f"list_extract([{', '.join(map(text, labels))}], list_position([{tests}, true], true))"


def flag(condition: str, labels) -> str:
    """The second of two labels where the (never null) condition holds."""
    return f"list_extract([{text(labels[0])}, {text(labels[1])}], 1 + ({condition})::INT)"


def bare(x: str) -> str:
    """A padded number without blanks and leading zeros."""
    return f"ltrim(trim({x}), '0')"


def filled(x: str) -> str:
    return f"nullif(trim({x}), '')"


def has(x: str) -> str:
    """Neither null nor blank."""
    return f"length(trim(coalesce({x}, ''))) > 0"


def day(back: int, as_of: str) -> str:
    return text((dt.date.fromisoformat(as_of) - dt.timedelta(days=back)).isoformat())


def newest(rows: str, keys: str, rank: str) -> str:
    """The row of each key with the greatest rank (a null above all)."""
    return f"SELECT unnest(arg_max(t, ({rank}))) FROM ({rows}) t GROUP BY {keys}"


def lowest(rows: str, keys: str, rank: str) -> str:
    """The row of each key with the smallest rank (a null last)."""
    return f"SELECT unnest(arg_min(t, ({rank}))) FROM ({rows}) t GROUP BY {keys}"


def ranked(rows: str, keys: str, order: str) -> str:
    """The first row of each key, for orders that mix directions."""
    return f"SELECT * FROM ({rows}) t QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
