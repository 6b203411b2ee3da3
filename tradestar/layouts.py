"""Source layouts: column names of the landing files and their bronze names.

Layouts are configuration, not code: the trade files are read by header name
(``{source: target}``), the registry archives by position (``[target, ...]``).
Types are ours (codes stay strings so leading zeros survive; ``ano``/``mes``
are int; measures decimal(18,2)) and follow from a rule on the target name.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the published layouts of the source files.
# Trade layouts, by header name, source column -> bronze column, file order.
# ---------------------------------------------------------------------------
TRADE_LAYOUTS: dict[str, dict[str, str]] = {
    "EXPO_2021": {
        "CO_ANO": "ano", "CO_MES": "mes", "CO_NCM": "codigo_ncm",
        "CO_UNID": "unidade_estatistica", "CO_PAIS": "codigo_pais_destino",
        "SG_UF_NCM": "uf_origem", "CO_VIA": "codigo_via_transporte",
        "CO_URF": "codigo_alfandega", "QT_ESTAT": "quantidade_estatistica",
        "KG_LIQUIDO": "peso_liquido_kg", "VL_FOB": "valor_fob_usd",
    },
    "IMP_2021": {
        "CO_ANO": "ano", "CO_MES": "mes", "CO_NCM": "codigo_ncm",
        "CO_UNID": "unidade_estatistica", "CO_PAIS": "codigo_pais_origem",
        "SG_UF_NCM": "uf_destino", "CO_VIA": "codigo_via_transporte",
        "CO_URF": "codigo_alfandega", "QT_ESTAT": "quantidade_estatistica",
        "KG_LIQUIDO": "peso_liquido_kg", "VL_FOB": "valor_fob_usd",
        "VL_FRETE": "valor_frete_usd", "VL_SEGURO": "valor_seguro_usd",
    },
    "EXP_2021_MUN": {
        "CO_ANO": "ano", "CO_MES": "mes", "SH4": "codigo_sh4",
        "CO_PAIS": "codigo_pais_destino", "SG_UF_MUN": "uf_municipio",
        "CO_MUN": "codigo_municipio", "KG_LIQUIDO": "peso_liquido_kg",
        "VL_FOB": "valor_fob_usd",
    },
    "IMP_2021_MUN": {
        "CO_ANO": "ano", "CO_MES": "mes", "SH4": "codigo_sh4",
        "CO_PAIS": "codigo_pais_origem", "SG_UF_MUN": "uf_municipio",
        "CO_MUN": "codigo_municipio", "KG_LIQUIDO": "peso_liquido_kg",
        "VL_FOB": "valor_fob_usd",
    },
    "ISIS_CUCI": {
        "CO_ISIC_SECAO": "codigo_isic_secao", "NO_ISIC_SECAO": "descricao_isic_secao",
        "CO_CUCI_GRUPO": "codigo_cuci_grupo", "NO_CUCI_GRUPO": "descricao_cuci_grupo",
    },
    "NCM": {
        "CO_NCM": "codigo_ncm", "CO_UNID": "unidade_estatistica", "CO_SH6": "codigo_sh6",
        "CO_PPE": "codigo_ppe_exportacao", "CO_PPI": "codigo_ppi_importacao",
        "CO_FAT_AGREG": "codigo_fator_agregacao", "CO_CUCI_ITEM": "codigo_cuci_item",
        "CO_CGCE_N3": "codigo_cgce_n3", "CO_SIIT": "codigo_siit",
        "CO_ISIC_CLASSE": "codigo_isic_classe", "CO_EXP_SUBSET": "codigo_subset_exportacao",
        "NO_NCM_POR": "descricao_ncm_pt", "NO_NCM_ESP": "descricao_ncm_es",
        "NO_NCM_ING": "descricao_ncm_en",
    },
    "NCM_CGCE": {
        "CO_CGCE_N3": "codigo_cgce_n3", "NO_CGCE_N3": "descricao_cgce_n3_pt",
        "NO_CGCE_N3_ING": "descricao_cgce_n3_en", "NO_CGCE_N3_ESP": "descricao_cgce_n3_es",
        "CO_CGCE_N2": "codigo_cgce_n2", "NO_CGCE_N2": "descricao_cgce_n2_pt",
        "NO_CGCE_N2_ING": "descricao_cgce_n2_en", "NO_CGCE_N2_ESP": "descricao_cgce_n2_es",
        "CO_CGCE_N1": "codigo_cgce_n1", "NO_CGCE_N1": "descricao_cgce_n1_pt",
        "NO_CGCE_N1_ING": "descricao_cgce_n1_en", "NO_CGCE_N1_ESP": "descricao_cgce_n1_es",
    },
    "NCM_CUCI": {
        "CO_CUCI_ITEM": "codigo_cuci_item", "NO_CUCI_ITEM": "descricao_cuci_item",
        "CO_CUCI_SUB": "codigo_cuci_subgrupo", "NO_CUCI_SUB": "descricao_cuci_subgrupo",
        "CO_CUCI_GRUPO": "codigo_cuci_grupo", "NO_CUCI_GRUPO": "descricao_cuci_grupo",
        "CO_CUCI_DIVISAO": "codigo_cuci_divisao", "NO_CUCI_DIVISAO": "descricao_cuci_divisao",
        "CO_CUCI_SEC": "codigo_cuci_secao", "NO_CUCI_SEC": "descricao_cuci_secao",
    },
    "NCM_FAT_AGREG": {
        "CO_FAT_AGREG": "codigo_fator_agregacao", "NO_FAT_AGREG": "descricao_fator_agregacao",
        "NO_FAT_AGREG_GP": "descricao_fator_agregacao_grupo",
    },
    "NCM_ISIC": {
        "CO_ISIC_CLASSE": "codigo_isic_classe", "NO_ISIC_CLASSE": "descricao_isic_classe_pt",
        "NO_ISIC_CLASSE_ING": "descricao_isic_classe_en",
        "NO_ISIC_CLASSE_ESP": "descricao_isic_classe_es",
        "CO_ISIC_GRUPO": "codigo_isic_grupo", "NO_ISIC_GRUPO": "descricao_isic_grupo_pt",
        "NO_ISIC_GRUPO_ING": "descricao_isic_grupo_en",
        "NO_ISIC_GRUPO_ESP": "descricao_isic_grupo_es",
        "CO_ISIC_DIVISAO": "codigo_isic_divisao", "NO_ISIC_DIVISAO": "descricao_isic_divisao_pt",
        "NO_ISIC_DIVISAO_ING": "descricao_isic_divisao_en",
        "NO_ISIC_DIVISAO_ESP": "descricao_isic_divisao_es",
        "CO_ISIC_SECAO": "codigo_isic_secao", "NO_ISIC_SECAO": "descricao_isic_secao_pt",
        "NO_ISIC_SECAO_ING": "descricao_isic_secao_en",
        "NO_ISIC_SECAO_ESP": "descricao_isic_secao_es",
    },
    "NCM_PPE": {
        "CO_PPE": "codigo_ppe", "NO_PPE": "descricao_ppe",
        "NO_PPE_MIN": "descricao_ppe_resumida", "NO_PPE_ING": "descricao_ppe_en",
    },
    "NCM_PPI": {
        "CO_PPI": "codigo_ppi", "NO_PPI": "descricao_ppi",
        "NO_PPI_MIN": "descricao_ppi_resumida", "NO_PPI_ING": "descricao_ppi_en",
    },
    "NCM_SH": {
        "CO_SH6": "codigo_sh6", "NO_SH6_POR": "descricao_sh6_pt",
        "NO_SH6_ESP": "descricao_sh6_es", "NO_SH6_ING": "descricao_sh6_en",
        "CO_SH4": "codigo_sh4", "NO_SH4_POR": "descricao_sh4_pt",
        "NO_SH4_ESP": "descricao_sh4_es", "NO_SH4_ING": "descricao_sh4_en",
        "CO_SH2": "codigo_sh2", "NO_SH2_POR": "descricao_sh2_pt",
        "NO_SH2_ESP": "descricao_sh2_es", "NO_SH2_ING": "descricao_sh2_en",
        "CO_NCM_SECROM": "codigo_secao_ncm", "NO_SEC_POR": "descricao_secao_ncm_pt",
        "NO_SEC_ESP": "descricao_secao_ncm_es", "NO_SEC_ING": "descricao_secao_ncm_en",
    },
    "NCM_UNIDADE": {
        "CO_UNID": "codigo_unidade", "NO_UNID": "descricao_unidade", "SG_UNID": "sigla_unidade",
    },
    "PAIS": {
        "CO_PAIS": "codigo_pais", "CO_PAIS_ISON3": "codigo_pais_iso_num",
        "CO_PAIS_ISOA3": "codigo_pais_iso3", "NO_PAIS": "nome_pais_pt",
        "NO_PAIS_ING": "nome_pais_en", "NO_PAIS_ESP": "nome_pais_es",
    },
    "PAIS_BLOCO": {
        "CO_PAIS": "codigo_pais", "CO_BLOCO": "codigo_bloco_economico",
        "NO_BLOCO": "nome_bloco_pt", "NO_BLOCO_ING": "nome_bloco_en",
        "NO_BLOCO_ESP": "nome_bloco_es",
    },
    "UF": {
        "CO_UF": "codigo_uf", "SG_UF": "sigla_uf", "NO_UF": "nome_uf", "NO_REGIAO": "nome_regiao",
    },
    "UF_MUN": {
        "CO_MUN_GEO": "codigo_municipio_ibge", "NO_MUN": "nome_municipio",
        "NO_MUN_MIN": "nome_municipio_curto", "SG_UF": "sigla_uf",
    },
    "URF": {"CO_URF": "codigo_alfandega", "NO_URF": "nome_alfandega"},
    "VIA": {"CO_VIA": "codigo_via_transporte", "NO_VIA": "descricao_via_transporte"},
}

# Registry layouts, header-less files, column names by position.
REGISTRY_LAYOUTS: dict[str, list[str]] = {
    "EMPRECSV": ["cnpj_basico", "razao_social", "nome_fantasia", "capital_social", "porte",
                 "qualificacao_responsavel", "natureza_juridica",
                 "ente_federativo_responsavel", "situacao_especial", "data_situacao_especial"],
    "ESTABELE": ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "nome_fantasia",
                 "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
                 "nome_cidade_exterior", "pais", "data_inicio_atividade", "cnae_principal",
                 "cnae_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
                 "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2",
                 "ddd_fax", "fax", "email", "situacao_especial", "data_situacao_especial"],
    "SOCIOCSV": ["cnpj_basico", "identificador_socio", "nome_socio", "cnpj_cpf_socio",
                 "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
                 "qualificacao_representante", "faixa_etaria"],
    "CNAECSV": ["cnae", "descricao"],
    "MUNICIPIOS": ["codigo_municipio", "nome_municipio"],
    "NATUREZAS": ["codigo_natureza_juridica", "descricao"],
    "PAISES": ["codigo_pais", "descricao"],
    "QUALIFICACOES": ["codigo_qualificacao", "descricao"],
    "SIMPLES": ["cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples",
                "opcao_mei", "data_opcao_mei", "data_exclusao_mei"],
    "MOTIVOS": ["codigo_motivo", "descricao"],
}

# Registry entity -> archive glob and bronze folder.
REGISTRY_ARCHIVES: dict[str, tuple[str, str]] = {
    "EMPRECSV": ("Empresas*.zip", "empresas"),
    "ESTABELE": ("Estabelecimentos*.zip", "estabelecimentos"),
    "SOCIOCSV": ("Socios*.zip", "socios"),
    "SIMPLES": ("Simples*.zip", "simples"),
    "CNAECSV": ("Cnaes*.zip", "cnaes"),
    "MOTIVOS": ("Motivos*.zip", "motivos"),
    "MUNICIPIOS": ("Municipios*.zip", "municipios"),
    "NATUREZAS": ("Naturezas*.zip", "naturezas"),
    "PAISES": ("Paises*.zip", "paises"),
    "QUALIFICACOES": ("Qualificacoes*.zip", "qualificacoes"),
}

# Member-file extensions that the registry archives use, plus plain formats.
SUPPORTED_EXTENSIONS = (
    ".csv", ".txt", ".parquet", ".json", ".xlsx", ".zip",
    ".emprecsv", ".estabele", ".sociocsv", ".simples", ".cnaecsv",
    ".motivos", ".municipios", ".naturezas", ".paises", ".qualificacoes",
)
REGISTRY_EXTENSIONS = SUPPORTED_EXTENSIONS[6:]

# Language suffixes dropped from trusted tables.
FOREIGN_SUFFIXES = ("_ing", "_esp", "_en", "_es", "_english", "_spanish")

# Candidate delimiters for sniffing, and the default.
CANDIDATE_DELIMITERS = (",", ";", "\t", "|")
DEFAULT_DELIMITER = ","

# Maintenance settings.
COMPACTION_TARGET_BYTES = 10 * 1024 * 1024
# --------------------------------------------------------------------------- end fixed values

# Trade entities: bronze folder -> (file glob, layout key). Globs are exact
# about the year so that the municipal files never match the plain ones.
TRADE_ENTITIES: dict[str, tuple[str, str | None]] = {
    "exp": ("EXP_[0-9][0-9][0-9][0-9].csv", "EXPO_2021"),
    "imp": ("IMP_[0-9][0-9][0-9][0-9].csv", "IMP_2021"),
    "exp_mun": ("EXP_[0-9][0-9][0-9][0-9]_MUN.csv", "EXP_2021_MUN"),
    "imp_mun": ("IMP_[0-9][0-9][0-9][0-9]_MUN.csv", "IMP_2021_MUN"),
    "ncm": ("NCM.csv", "NCM"),
    "pais": ("PAIS.csv", "PAIS"),
    "via": ("VIA.csv", "VIA"),
    "ncm_unidade": ("NCM_UNIDADE.csv", "NCM_UNIDADE"),
    "ncm_cgce": ("NCM_CGCE.csv", "NCM_CGCE"),
    "ncm_cuci": ("NCM_CUCI.csv", "NCM_CUCI"),
    "ncm_isic": ("NCM_ISIC.csv", "NCM_ISIC"),
    "ncm_itn": ("NCM_ITN.csv", None),
    "isis_cuci": ("ISIS_CUCI.csv", "ISIS_CUCI"),
    "ncm_fat_agreg": ("NCM_FAT_AGREG.csv", "NCM_FAT_AGREG"),
    "ncm_ppe": ("NCM_PPE.csv", "NCM_PPE"),
    "ncm_ppi": ("NCM_PPI.csv", "NCM_PPI"),
    "ncm_sh": ("NCM_SH.csv", "NCM_SH"),
    "pais_bloco": ("PAIS_BLOCO.csv", "PAIS_BLOCO"),
    "uf": ("UF.csv", "UF"),
    "uf_mun": ("UF_MUN.csv", "UF_MUN"),
    "urf": ("URF.csv", "URF"),
}

# File-name aliases: the export files are called EXP_* while the layout key is
# EXPO_2021, so the resolver sees an extra key that points at that layout.
LAYOUT_ALIASES: dict[str, str] = {"EXP_2021": "EXPO_2021"}

INT_COLUMNS = frozenset({"ano", "mes"})
DECIMAL_COLUMNS = frozenset({"quantidade_estatistica", "peso_liquido_kg", "valor_fob_usd",
                             "valor_frete_usd", "valor_seguro_usd"})
MEASURE_TYPE = T.DecimalType(18, 2)


def target_type(name: str) -> T.DataType:
    """Bronze type of a trade column, by rule on its target name."""
    if name in INT_COLUMNS:
        return T.IntegerType()
    if name in DECIMAL_COLUMNS:
        return MEASURE_TYPE
    return T.StringType()


def source_schema(layout_key: str, typed: bool = True) -> T.StructType:
    """Schema of a trade landing file, by *source* header name.

    Used with ``enforceSchema=false`` so that a file whose header disagrees is
    rejected instead of being read by position.
    """
    layout = TRADE_LAYOUTS[layout_key]
    return T.StructType([
        T.StructField(src, target_type(dst) if typed else T.StringType(), True)
        for src, dst in layout.items()
    ])


def target_schema(layout_key: str) -> T.StructType:
    """Schema of a bronze/silver trade table, by target name."""
    return T.StructType([T.StructField(dst, target_type(dst), True)
                         for dst in TRADE_LAYOUTS[layout_key].values()])


def registry_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True)
                         for c in REGISTRY_LAYOUTS[entity]])


def layout_rows() -> list[tuple[str, str, int]]:
    """(key, target layout, declaration order) for the resolver table; the
    aliases come after the real keys."""
    rows = [(k, k, i) for i, k in enumerate(TRADE_LAYOUTS)]
    n = len(rows)
    rows += [(alias, target, n + i) for i, (alias, target) in enumerate(LAYOUT_ALIASES.items())]
    return rows
