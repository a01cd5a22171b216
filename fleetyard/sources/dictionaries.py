"""Small code tables (text catalogues) used by the test-data source.

These are catalogue tables in the replica (activity types, priorities, order
types, planner groups, status texts, storage locations): their size is fixed
by the code catalogue, not by the data volume, which is why joins against
them may broadcast.
"""

# Code -> text rows, in the replica's column order.
NON_STOCK_TEXT = "Item não estocável"

# t353i_t: (ilart, spras, ilatx)
ACTIVITY_TEXTS = [
    ("PRP", "P", "Preparação de máquina"),
    ("PRP", "E", "Machine preparation"),
    ("OFI", "P", "Oficina mecânica"),
    ("X01", "P", "Serviço de oficina"),
    ("X02", "P", "Revisão de preparo"),
    ("X02", "P", "Preparo final"),
    ("INS", "P", "Inspeção"),
    ("INS", "E", "Inspection"),
]

# t356_t: (priok, artpr, spras, priokx)
PRIORITY_TEXTS = [
    ("1", "ZZ", "P", "Urgente"),
    ("1", "PM", "P", "Muito alta"),
    ("1", "PM", "E", "Very high"),
    ("2", "PM", "P", "Alta"),
    ("3", "PM", "P", "Média"),
    ("4", "PM", "P", "Baixa"),
]

# t003p: (auart, spras, txt)
ORDER_TYPE_TEXTS = [
    ("PM00", "P", "Corretiva"),
    ("PM01", "P", "Preventiva"),
    ("PM01", "E", "Preventive"),
    ("PM02", "P", "Preditiva"),
]

# t024i: (ingrp, iwerk, innam)
PLANNER_GROUPS = [
    ("G0", "W2", "Planejamento Sul"),
    ("G0", "W1", "Planejamento Norte"),
    ("G1", "W1", "Oficina Central"),
    ("G2", "W3", "Campo"),
]

# tj30t: (stsma, estat, spras, txt04) — status profile names are padded in the replica
USER_STATUS_TEXTS = [
    ("ZPM00001  ", "E0001", "P", "ABER"),
    ("ZPM00001  ", "E0002", "P", "AGPC"),
    ("ZPM00001  ", "E0003", "P", "AGUA"),
    ("ZPM00001  ", "E0001", "E", "OPEN"),
    (" ZPM00002", "E0001", "P", "INIC"),
    (" ZPM00002", "E0002", "P", "EXEC"),
    (" ZPM00002", "E0003", "P", "ABER"),
]

# tj02t: (istat, spras, txt04)
SYSTEM_STATUS_TEXTS = [
    ("I0002", "P", "LIB"),
    ("I0002", "E", "REL"),
    ("I0009", "P", "CONF"),
    ("I0045", "P", "ENTE"),
]

# t001l: (werks, lgort)
STORAGE_LOCATIONS = [
    ("C000", "D777"),
    ("C001", "D005"),
    ("C002", "D090"),
    ("C002", "D007"),
    ("C003", "D002"),
    ("C004", "D999"),
    ("C005", "D123"),
    ("C006", "D071"),
    ("C007", "D888"),
]

# Picking storage locations the reservation and purchasing reports are scoped to.
PICKING_LOCATIONS = ("D005", "D090", "D007", "D002", "D123", "D071")
