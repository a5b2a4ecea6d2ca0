"""Source table layouts and target table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source table name and source column -> column name used here.
SOURCES: dict[str, tuple[str, dict[str, str]]] = {
    "contract_lines": (
        "ViewOrcamentosLojas",
        {
            "IdOrcamento": "contract_id",
            "StatusPedido": "status",
            "IdCliente": "customer_id",
            "NomeCliente": "customer_name",
            "NomeSistemaCliente": "system_name",
            "IdClienteLoja": "store_client_id",
            "NomeClienteLoja": "store_client_name",
            "DiaFaturamento": "billing_day",
            "DiaVencimento": "due_day",
            "IdOrcamentoLoja": "line_id",
            "IdEstabelecimento": "store_id",
            "IdBandeira": "brand_id",
            "IdRede": "chain_id",
            "IdTarefa": "task_id",
            "NomeTarefa": "task_name",
            "SegmentosProdutos": "segment_names",
            "Frequencia": "frequency",
            "Horas": "hours",
            "ValorNegociado": "price",
            "DataInicioOperacao": "start_at",
            "DataAvisoPrevio": "notice_at",
            "DataInclusaoOrcamento": "contract_created_at",
            "DataAlteracaoOrcamento": "contract_updated_at",
            "DataInclusaoOrcamentoLojas": "line_created_at",
            "DataAlteracaoOrcamentoLojas": "line_updated_at",
        },
    ),
    "contract_master": (
        "Orcamento",
        {
            "Id": "contract_id",
            "IdUsuarioVendedor": "seller_id",
            "ModoFaturamento": "billing_mode",
            "TipoOrcamento": "operation",
            "TipoCalculoDecimoTerceiro": "thirteenth_rule",
            "TradeMarketing": "trade_marketing",
            "ValorEPI": "equipment_amount",
            "ValorTradeMarketing": "trade_amount",
            "ValorOutros": "other_amount",
            "Juros": "interest_amount",
            "Desconto": "discount_amount",
            "Multa": "fine_amount",
            "CobrarEPI": "equipment_charged",
            "InicioCobrancaEPI": "equipment_start_at",
            "DataInclusao": "created_at",
            "DataAlteracao": "updated_at",
        },
    ),
    "line_flags": ("OrcamentoLojas", {"Id": "line_id", "Ativo": "active"}),
    "parties": (
        "Cliente",
        {
            "Id": "id",
            "Codigo": "code",
            "NomeSistema": "system_name",
            "TipoPessoa": "person_type",
            "CpfCnpj": "tax_id",
            "InscricaoEstadual": "state_registration",
            "InscricaoMunicipal": "municipal_registration",
            "RazaoSocial": "legal_name",
            "NomeFantasia": "trade_name",
            "Ativo": "active",
            "Endereco": "main_street",
            "Numero": "main_number",
            "Complemento": "main_address_line_2",
            "Bairro": "main_neighborhood",
            "CEP": "main_postal_code",
            "Cidade": "main_city",
            "CodigoMunicipio": "main_place_code",
            "UF": "main_state",
            "Latitude": "main_latitude",
            "Longitude": "main_longitude",
            "EnderecoCobranca": "billing_street",
            "NumeroCobranca": "billing_number",
            "ComplementoCobranca": "billing_address_line_2",
            "BairroCobranca": "billing_neighborhood",
            "CepCobranca": "billing_postal_code",
            "CidadeCobranca": "billing_city",
            "CodigoMunicipioCobranca": "billing_place_code",
            "UFCobranca": "billing_state",
            "Email": "email",
            "EmailResponsavel": "responsible_email",
            "EmailCobranca": "billing_emails",
            "EmailUsuarioComercialResponsavel": "commercial_email",
            "Telefone": "phone",
            "Celular": "cellphone",
            "TelefoneResponsavel": "responsible_phone",
            "PessoaContato": "contact_person",
            "FuncaoPgtoFaturamento": "contact_job",
            "ResponsavelCompra": "buyer",
            "FuncaoResponsavel": "buyer_job",
            "Observacoes": "notes",
            "NomeSocio": "shareholder_name",
            "CargoSocio": "shareholder_job",
            "DataInativacao": "deactivated_at",
            "EnderecoSocio": "shareholder_street",
            "NumeroSocio": "shareholder_number",
            "ComplementoSocio": "shareholder_address_line_2",
            "BairroSocio": "shareholder_neighborhood",
            "CEPSocio": "shareholder_postal_code",
            "CidadeSocio": "shareholder_city",
            "CodigoMunicipioSocio": "shareholder_place_code",
            "UFSocio": "shareholder_state",
            "TelefoneSocio": "shareholder_phone",
            "CPFSocio": "shareholder_national_id",
            "RGSocio": "shareholder_identity_card",
            "NacionalidadeSocio": "shareholder_nationality",
            "EstCivilSocio": "shareholder_marital_status",
            "DataInclusao": "created_at",
            "DataAlteracao": "updated_at",
            "DataAtivacao": "activated_at",
        },
    ),
    "store_records": (
        "Estabelecimento",
        {
            "Id": "id",
            "codigo": "code",
            "NomeFantasia": "name",
            "IdBandeira": "brand_id",
            "IdCanalEstabelecimento": "channel_id",
            "Cnpj": "tax_id",
            "Endereco": "main_street",
            "Numero": "main_number",
            "Complemento": "main_address_line_2",
            "Bairro": "main_neighborhood",
            "CEP": "main_postal_code",
            "Cidade": "main_city",
            "UF": "main_state",
            "Latitude": "main_latitude",
            "Longitude": "main_longitude",
            "Email": "email",
            "Telefone": "phone",
            "CelularGerente": "cellphone",
            "Ativo": "active",
            "DataInclusao": "created_at",
            "DataAlteracao": "updated_at",
        },
    ),
    "brands": (
        "Bandeira",
        {
            "Id": "id", "NomeFantasia": "name", "Codigo": "code", "IdRede": "chain_id",
            "Ativo": "active", "DataInclusao": "created_at", "DataAlteracao": "updated_at",
        },
    ),
    "chains": (
        "Rede",
        {
            "Id": "id", "Nome": "name", "Codigo": "code", "Ativo": "active",
            "DataInclusao": "created_at", "DataAlteracao": "updated_at",
        },
    ),
    "segments": (
        "SegmentoProduto",
        {
            "Id": "id", "Nome": "name", "Ativo": "active", "DataInclusao": "created_at",
            "DataAlteracao": "updated_at",
        },
    ),
    "channels": (
        "CanalEstabelecimento",
        {
            "Id": "id", "Nome": "name", "Ativo": "active", "DataInclusao": "created_at",
            "DataAlteracao": "updated_at",
        },
    ),
    "places": ("Municipio", {"CodigoMunicipio": "code", "NomeMunicipio": "city", "UF": "state"}),
    "source_users": (
        "Usuario",
        {
            "Id": "id", "Nome": "name", "Login": "login", "Email": "email", "Telefone": "phone",
            "Senha": "password_hash", "Cpf": "national_id", "Ativo": "active",
            "DataInclusao": "created_at", "DataAlteracao": "updated_at",
        },
    ),
}

_CREATED_UPDATED = "created_at timestamp_ntz, updated_at timestamp_ntz"
_TERMS = (
    "contract_parameters_billing_day int, contract_parameters_due_day int, "
    "contract_parameters_billing_type string, contract_parameters_thirteenth_salary_type string"
)

# Target table -> columns.
TARGETS: dict[str, str] = {
    "customer_segments": "id string, name string, is_active boolean, "
    f"{_CREATED_UPDATED}, legacy_id bigint",
    "customers": "id string, cnpj string, cnpj_status string, "
    "state_registration string, municipal_registration string, legal_name string, "
    f"trade_name string, simple_opt boolean, status string, {_CREATED_UPDATED}, code bigint",
    "customer_legacy_ids": "legacy_id bigint, id string",
    "addresses": "id string, legacy_id bigint, addressable_id string, addressable_type string, "
    "type string, postal_code string, street string, number string, address_line_2 string, "
    "neighborhood string, city string, state string, municipal_code bigint, latitude double, "
    f"longitude double, zone string, region string, {_CREATED_UPDATED}",
    "contacts": "id string, contactable_id string, contactable_type string, type string, "
    f"value string, {_CREATED_UPDATED}",
    "customer_brands": "id string, name string, customer_segment_id string, is_active boolean, "
    f"{_CREATED_UPDATED}",
    "customer_customer_brand": "customer_id string, customer_brand_id string",
    "store_segments": f"id string, name string, is_active boolean, {_CREATED_UPDATED}, "
    "legacy_id bigint",
    "retail_chains": "id string, name string, description string, is_active boolean, "
    f"{_CREATED_UPDATED}, legacy_id bigint",
    "store_brands": "id string, description string, abras_code string, retail_chain_id string, "
    f"store_segment_id string, is_active boolean, {_CREATED_UPDATED}, legacy_id bigint",
    "stores": f"id string, name string, store_brand_id string, is_active boolean, "
    f"{_CREATED_UPDATED}, legacy_id bigint, code string",
    "store_cnpjs": "id string, cnpj string, is_main boolean, store_id string, is_active boolean, "
    f"{_CREATED_UPDATED}",
    "users": "id string, legacy_id bigint, name string, user_name string, "
    "normalized_user_name string, email string, normalized_email string, phone_number string, "
    f"password_hash string, status string, {_CREATED_UPDATED}, deleted_at timestamp_ntz, "
    "email_confirmed boolean, email_confirmed_at timestamp_ntz, phone_number_confirmed boolean, "
    "temporary_password boolean, two_factor_enabled boolean, lockout_enabled boolean, "
    "lockout_end timestamp_ntz, access_failed_count int, security_stamp string, "
    "concurrency_stamp string",
    "user_roles": "user_id string, role_id string",
    "contracts": f"id string, legacy_id bigint, code bigint, customer_id string, {_TERMS}, "
    "operation_type string, trade_type string, start_date timestamp_ntz, "
    "end_date timestamp_ntz, status string, deleted_at timestamp_ntz, observations string, "
    f"expected_amount double, {_CREATED_UPDATED}, title string, legacy_customer_id bigint",
    "promoter_tasks": "id string, name string, task_type string, is_active boolean, "
    f"{_CREATED_UPDATED}",
    "contract_scenarios": "id string, legacy_id bigint, contract_id string, "
    "promoter_task_id string, frequency string, hours double, hour_value decimal(18,2), "
    "start_date date, end_date date, status int, deleted_at timestamp_ntz, "
    f"expected_amount double, {_CREATED_UPDATED}, billing_id string",
    "contract_scenario_stores": "id string, legacy_id bigint, scenario_id string, "
    "store_id string, start_date timestamp_ntz, status string, closed_at date, "
    f"{_CREATED_UPDATED}",
    "contract_sellers": "id string, contract_id string, user_id string, seller_type string, "
    f"{_CREATED_UPDATED}, status string",
    "contract_team_members": "id string, contract_id string, user_id string, position string, "
    f"{_CREATED_UPDATED}",
    "contract_contacts": f"id string, contract_id string, name string, {_CREATED_UPDATED}",
    "contract_partners": "id string, contract_id string, person_id string, position string, "
    f"phone string, email string, {_CREATED_UPDATED}",
    "contract_additional_charges": "id string, contract_id string, billing_id string, "
    "amount decimal(18,2), charge_type string, billing_model string, start_date date, "
    f"end_date date, {_CREATED_UPDATED}",
    "contract_scenarios_brands": "scenario_id string, customer_brand_id string",
    "billings": "id string, customer_id string, name string, observations string, "
    f"deleted_at timestamp_ntz, is_active boolean, {_CREATED_UPDATED}, "
    f"calculation_type string, {_TERMS}",
    # Older client model.
    "client_customers": "customer_id string, legado_cliente_id bigint, "
    "legado_cliente_code bigint, legado__nomesistema string, entity_type string, "
    "tax_id_type string, tax_id string, registration_state int, registration_municipal int, "
    f"legal_name string, trade_name string, status string, {_CREATED_UPDATED}, "
    "activated_date timestamp_ntz, coment string",
    "client_addresses": "address_id string, address_type string, addressable_type string, "
    "addressable_id bigint, legacy_cliente_id bigint, legacy_cliente_code bigint, "
    "street string, house_num string, complement1 string, district string, cep string, "
    "city string, city_code string, region_code string, country string, status string, "
    f"{_CREATED_UPDATED}",
    "client_contacts": "contact_id string, customer_id string, contact_name string, "
    f"job_title string, coment string, status string, {_CREATED_UPDATED}",
    "client_emails": "contact_email_id string, customer_id string, email_type string, "
    f"email string, status string, {_CREATED_UPDATED}",
    "client_phones": "contact_phone_id string, customer_id string, phone_type string, "
    f"country_code string, area_code string, number string, status string, {_CREATED_UPDATED}",
    "shareholders": "shareholder_id string, customer_id string, contact_id string, "
    "role_label string, start_date timestamp_ntz, end_date timestamp_ntz, status string, "
    f"{_CREATED_UPDATED}",
    "shareholder_phones": "shareholder_phone__id string, shareholder_id string, "
    "phone_type string, country_code string, area_code string, number string, status string, "
    f"{_CREATED_UPDATED}",
    "shareholder_pii": "shareholder_id string, cpf string, rg string, nationality string, "
    f"marital_status string, job_title string, status string, {_CREATED_UPDATED}",
    # Scope and run history.
    "scope": "dimension string, id bigint",
    "run_history": "run_at timestamp_ntz, target string, seconds double, measures map<string,bigint>",
}

# Tables that are replaced by a key of which no two rows share a value: their folders are bucketed by
# it. Child tables are not, as a hot parent would be one bucket and so one task.
BUCKETED: dict[str, str] = {
    "retail_chains": "legacy_id", "store_brands": "legacy_id", "stores": "legacy_id",
    "contracts": "legacy_id", "customers": "id",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TARGETS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a target table, in order and cast to its types; missing ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(table)
        ]
    )


def rename_source(df: DataFrame, name: str) -> DataFrame:
    """Source columns under the names used here; columns the source lacks are left out."""
    columns = SOURCES[name][1]
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[F.col(present[s.lower()]).alias(ours) for s, ours in columns.items() if s.lower() in present]
    )
