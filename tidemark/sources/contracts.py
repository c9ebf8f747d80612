"""The sheets of a catalogue submission: what each must have, whose domain it takes, which dates it declares."""

from __future__ import annotations

from .sheets import Contract

STORED = "yyyy-MM-dd HH:mm:ss"

# Names of sheets and of their columns.
ATTRIBUTES = Contract(
    "DetalleAtributos",
    (
        "codigo_dominio", "codigo_atributo", "atributo", "descripcion_atributo", "nivel_criticidad", "reporte", "proyecto", "proceso", "estructura", "es_dato_personal",
        "categoria_nivel_1", "tipo_dato", "sensibilidad", "tipo_atributo", "compartido_similar", "atributo_primario", "dominio_primario", "fecha_aprobada",
    ),
    key="codigo_dominio",
    dates={"fecha_aprobada": STORED},
    whole=("codigo_atributo",),
)
OFFICIAL_SOURCES = Contract(
    "MetadataTecnica",
    (
        "codigo_dominio_atributo", "formula_calculo", "servidor_fuente_oficial", "base_datos_fuente_oficial", "tabla_fuente_oficial", "nombre_campo_fuente_oficial",
        "longitud_campo_fuente_oficial", "lista_valores_validos", "acepta_valores_nulos", "tipo_campo", "fecha_aprobada",
    ),
    key="codigo_dominio_atributo",
    by_prefix=True,
)
CONSUMPTION = Contract(
    "MetadataRepositorio",
    ("codigo_dominio_atributo", "clase", "coleccion_foc", "servidor_foc", "tabla_bv_foc", "nombre_campo_foc", "fecha_aprobada"),
    required=("codigo_dominio_atributo", "clase", "coleccion_foc", "servidor_foc", "tabla_bv_foc", "nombre_campo_foc", "fecha_aprobada"),
    key="codigo_dominio_atributo",
    by_prefix=True,
    dates={"fecha_aprobada": STORED},
)
RESEARCH = Contract("Investigacion", ("clasificacion", "nombre", "descripcion", "referencia_normativa"), key="codigo_dominio", inherits_key=True)
RESPONSIBLES = Contract("Estructura", ("rol", "area", "codigo_plaza", "nombre_plaza", "nombre_responsable", "fecha_aprobada"), key="codigo_dominio", inherits_key=True, dates={"fecha_aprobada": STORED})
EVIDENCE = Contract("Respaldos", ("tipo_respaldo", "enlace_respaldo", "observaciones", "fecha_aprobada"), key="codigo_dominio", inherits_key=True)
PLANS = Contract(
    "PlanDeRemediacion",
    (
        "codigo_dominio_atributo", "dimension", "categoria", "fuente_oficial_sistema", "tipo_plan", "categoria_plan", "subcategoria_plan", "priorizacion", "id_problema", "estado_actual",
        "fecha_identificacion", "fecha_finalizacion_definitiva", "descripcion_causa_raíz", "persona_responsable_ejecución_plan_remediación", "dependencias", "observacion",
        "acciones_resolucion_corto_plazo", "acciones_resolucion_definitivo", "avance", "fecha_ultima_modificacion", "siro",
    ),
    key="codigo_dominio_atributo",
    by_prefix=True,
    dates={"fecha_identificacion": STORED, "fecha_finalizacion_definitiva": STORED, "fecha_ultima_modificacion": STORED},
    whole=("avance",),
)

ALL = (ATTRIBUTES, OFFICIAL_SOURCES, CONSUMPTION, RESEARCH, RESPONSIBLES, EVIDENCE, PLANS)
#: Pairs of columns that a row of these sheets must have.
PAIRS = {RESEARCH.name: ("clasificacion", "nombre"), RESPONSIBLES.name: ("rol", "nombre_plaza"), EVIDENCE.name: ("tipo_respaldo", "enlace_respaldo"), PLANS.name: ("codigo_dominio_atributo", "id_problema")}
