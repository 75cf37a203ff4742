"""Lines of contract files, for the tests that write some."""

# The column labels of contract files.
HEADER = [
    "Entidad",
    "Nit Entidad",
    "Departamento",
    "Ciudad",
    "Estado",
    "Descripcion del Proceso",
    "Tipo de Contrato",
    "Modalidad de Contratacion",
    "Justificacion Modalidad de Contratacion",
    "Fecha de Firma",
    "Fecha de Inicio del Contrato",
    "Fecha de Fin del Contrato",
    "Precio Base",
    "Valor Total",
    "Valor Pagado",
]


def contract_line(entity: str, department: str, signed_on: str, price: str) -> str:
    values = dict.fromkeys(HEADER, "")
    values.update(
        {
            "Entidad": entity,
            "Departamento": department,
            "Fecha de Firma": signed_on,
            "Precio Base": price,
        }
    )
    return ",".join(values.values())
