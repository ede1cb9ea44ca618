"""A small landing file made for the tests: what each line is for stands beside
it. Lines are built from parts, so that a test's expectation can be read off here.
"""

_HEADER = ("id_transaccion,fecha_transaccion,tipo_transaccion,cliente_proveedor,cantidad_kwh,precio_kwh,"
           "tipo_energia,hora_transaccion,ciudad,nombre_proveedor,capacidad_mw,fecha_contrato,tipo_cliente")


def _line(n, day, kind, client, kwh, price, energy, city, provider, client_type, capacity="50", contract="2019-12-31"):
    return f"K{n},{day},{kind},{client},{kwh},{price},{energy},00:{n:02d}:00,{city},{provider},{capacity},{contract},{client_type}"


_LINES = [
    # three lines of one energy, city and day: 10 + 20 + 30 kWh, mean price 0.2
    _line(1, "2040-01-01", "venta", "Zoo", 10, 0.1, "hidro", "Oslo", "Norte", "comercial"),
    _line(2, "2040-01-01", "Venta", "Zoo", 20, 0.2, "hidro", "Oslo", "Norte", "comercial"),
    _line(3, "2040-01-01", "compra", "Yate", 30, 0.3, "hidro", "Oslo", "Norte", "industrial"),
    # the same energy elsewhere and on another day; a client seen with two types
    _line(4, "2040-01-02", "VENTA", "Zoo", 5.5, 1, "hidro", "Oslo", "Norte", "residencial"),
    _line(5, "2040-01-01", "compra", "Xilófono", 4.5, 1, "hidro", "Ærø", "Sur", "industrial"),
    # another energy, neither sale nor purchase; no client type
    _line(6, "2040-02-29", "ajuste", "Wanda", 100, 0.5, "solar", "Ærø", "Sur", ""),
    _line(7, "2040-02-29", "COMPRA", "Ñu", 0, 0.25, "solar", "Ærø", "Sur", "comercial"),
    # provider lines shifted by one column, between the others
    ",,,,,,,,Oeste,7.5,2018-01-01,",
    _line(8, "2040-03-01", "venta", "Ñu", 1.25, 0.75, "solar", "Łódź", "Este", "comercial"),
    ",,,,,,,,Centro,-3,2018-01-02,",
]
CONTRATOS_CSV = "\n".join([_HEADER, *_LINES]) + "\n"

RIESGOS_CSV = "tipo_cliente,riesgo_pct,comentario\ncomercial,3,\nindustrial,0.125,sin cambios\n"


def write_landing(root: str, contratos: str = CONTRATOS_CSV, riesgos: str | None = RIESGOS_CSV,
                  nested: bool = False) -> str:
    import os
    landing = os.path.join(root, "landing")
    cdir = os.path.join(landing, "contratos") if nested else landing
    os.makedirs(cdir, exist_ok=True)
    with open(os.path.join(cdir, "contratos.csv"), "w", encoding="utf-8") as f:
        f.write(contratos)
    if riesgos is not None:
        with open(os.path.join(landing, "riesgos_precios.csv"), "w", encoding="utf-8") as f:
            f.write(riesgos)
    return landing
