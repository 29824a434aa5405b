"""Household category groups, each (id, title, chart, columns)."""

from __future__ import annotations

# The column names must equal the headers of the tract file.
HOUSEHOLD_GROUPS = (
    (
        "domicilios_tipo_ocupado",
        "Tipo de Domicílio Ocupado",
        "pie",
        (
            "Domicílios Particulares Permanentes Ocupados",
            "Domicílios Particulares Improvisados Ocupados",
            "Unidades de Habitação em Domicílios Coletivos Com Morador",
        ),
    ),
    (
        "dppo_qtd_moradores",
        "Quantidade de Moradores — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Com 1 morador no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 2 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 3 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 4 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 5 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 6 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 7 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 8 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 9 moradores no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Com 10 ou mais moradores no domicílio",
        ),
    ),
    (
        "dppo_tipo_especie",
        "Tipo de Espécie — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é casa",
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é casa de vila ou em condomínio",
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é apartamento",
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é habitação em casa de cômodos ou cortiço",
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é habitação indígena sem paredes ou maloca",
            "Domicílios Particulares Permanentes Ocupados, Tipo de espécie é estrutura residencial permanente degradada ou inacabada",
        ),
    ),
    (
        "dpio_tipo_especie",
        "Tipo de Espécie — Domicílios Particulares Improvisados Ocupados",
        "bar",
        (
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é tenda ou barraca de lona, plástico ou tecido",
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é dentro de estabelecimento em funcionamento",
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é abrigo natural e outras estruturas improvisadas",
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é estrutura improvisada em logradouro público, exceto tenda ou barraca",
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é estrutura não residencial permanente degradada ou inacabada",
            "Domicílios Particulares Improvisados Ocupados, Tipo de espécie é veículo (carro, caminhão, trailer, barco etc)",
        ),
    ),
    (
        "dccm_tipo_especie",
        "Tipo de Espécie — Domicílios Coletivos Com Morador",
        "bar",
        (
            "Domicílios Coletivos Com Morador, Tipo de espécie é asilo ou outra instituição de longa permanência para idosos",
            "Domicílios Coletivos Com Morador, Tipo de espécie é hotel ou pensão",
            "Domicílios Coletivos Com Morador, Tipo de espécie é alojamento",
            "Domicílios Coletivos Com Morador, Tipo de espécie é penitenciária, centro de detenção e similar",
            "Domicílios Coletivos Com Morador, Tipo de espécie é outros domicílios coletivos com morador",
            "Domicílios Coletivos Com Morador, Tipo de espécie é abrigo, albergue ou casa de passagem para população em situação de rua",
            "Domicílios Coletivos Com Morador, Tipo de espécie é abrigo, casas de passagem ou república assistencial para outros grupos vulneráveis",
            "Domicílios Coletivos Com Morador, Tipo de espécie é clínica psiquiátrica, comunidade terapêutica e similar",
            "Domicílios Coletivos Com Morador, Tipo de espécie é orfanato e similar",
            "Domicílios Coletivos Com Morador, Tipo de espécie é unidade de internação de menores",
            "Domicílios Coletivos Com Morador, Tipo de espécie é quartel ou outra organização militar",
        ),
    ),
    (
        "dppo_abastecimento_agua",
        "Forma de Abastecimento de Água — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Utiliza rede geral de distribuição",
            "Domicílios Particulares Permanentes Ocupados, Utiliza poço profundo ou artesiano",
            "Domicílios Particulares Permanentes Ocupados, Utiliza poço raso, freático ou cacimba",
            "Domicílios Particulares Permanentes Ocupados, Utiliza fonte, nascente ou mina",
            "Domicílios Particulares Permanentes Ocupados, Utiliza carro-pipa",
            "Domicílios Particulares Permanentes Ocupados, Utiliza água da chuva armazenada",
            "Domicílios Particulares Permanentes Ocupados, Utiliza rios, açudes, córregos, lagos e igarapés",
            "Domicílios Particulares Permanentes Ocupados, Utiliza outra forma de abastecimento de água",
        ),
    ),
    (
        "dppo_agua_encanada",
        "Água Encanada — Domicílios Particulares Permanentes Ocupados",
        "pie",
        (
            "Domicílios Particulares Permanentes Ocupados, Água chega encanada até dentro da casa, apartamento ou habitação",
            "Domicílios Particulares Permanentes Ocupados, Água chega encanada, mas apenas ao terreno",
            "Domicílios Particulares Permanentes Ocupados, Água não chega encanada ao domicílio",
        ),
    ),
    (
        "dppo_banheiro_tipo",
        "Banheiro/Sanitário — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, 1 banheiro de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 2 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 3 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 4 ou mais banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, Apenas banheiro de uso comum a mais de um domicílio",
            "Domicílios Particulares Permanentes Ocupados, Apenas sanitário ou buraco para dejeções, inclusive os localizados no terreno",
            "Domicílios Particulares Permanentes Ocupados, Não tinham banheiro nem sanitário",
        ),
    ),
    (
        "dppo_destinacao_esgoto",
        "Destinação do Esgoto — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é rede geral ou pluvial",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é fossa séptica ou fossa filtro ligada à rede",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é fossa séptica ou fossa filtro não ligada à rede",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é fossa rudimentar ou buraco",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é vala",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é rio, lago, córrego ou mar",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto do banheiro ou sanitário ou buraco para dejeções é outra forma",
            "Domicílios Particulares Permanentes Ocupados, Destinação do esgoto inexistente, pois não tinham banheiro nem sanitário",
        ),
    ),
    (
        "dppo_destino_lixo",
        "Destino do Lixo — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Lixo coletado no domicílio por serviço de limpeza",
            "Domicílios Particulares Permanentes Ocupados, Lixo depositado em caçamba de serviço de limpeza",
            "Domicílios Particulares Permanentes Ocupados, Lixo queimado na propriedade",
            "Domicílios Particulares Permanentes Ocupados, Lixo enterrado na propriedade",
            "Domicílios Particulares Permanentes Ocupados, Lixo jogado em terreno baldio, encosta ou área pública",
            "Domicílios Particulares Permanentes Ocupados, Outro destino do lixo",
        ),
    ),
    (
        "dppo_qtd_banheiros",
        "Quantidade de Banheiros — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, 1 banheiro de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 2 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 3 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 4 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 5 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 6 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 7 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 8 banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
            "Domicílios Particulares Permanentes Ocupados, 9 ou mais banheiros de uso exclusivo com chuveiro e vaso sanitário existentes no domicílio",
        ),
    ),
    (
        "dppo_banheiro_exclusivo",
        "Banheiro de Uso Exclusivo — Domicílios Particulares Permanentes Ocupados",
        "pie",
        (
            "Domicílios Particulares Permanentes Ocupados, Com banheiro de uso exclusivo com chuveiro e vaso sanitário",
            "Domicílios Particulares Permanentes Ocupados, Sem banheiro de uso exclusivo com chuveiro e vaso sanitário",
        ),
    ),
    (
        "dpio_qtd_moradores",
        "Quantidade de Moradores — Domicílios Particulares Improvisados Ocupados",
        "bar",
        (
            "Domicílios Particulares Improvisados Ocupados, Quantidade de moradores",
        ),
    ),
    (
        "dccm_qtd_moradores",
        "Quantidade de Moradores — Domicílios Coletivos Com Morador",
        "bar",
        (
            "Domicílios Coletivos Com Morador, Quantidade de moradores",
        ),
    ),
    (
        "dppo_criancas_0a9",
        "Crianças 0–9 anos — Domicílios Particulares Permanentes Ocupados",
        "bar",
        (
            "Domicílios Particulares Permanentes Ocupados, Quantidade de crianças de zero a nove anos de idade",
        ),
    ),
    (
        "dpio_criancas_0a9",
        "Crianças 0–9 anos — Domicílios Particulares Improvisados Ocupados",
        "bar",
        (
            "Domicílios Particulares Improvisados Ocupados, Quantidade de crianças de zero a nove anos de idade",
        ),
    ),
    (
        "dccm_criancas_0a9",
        "Crianças 0–9 anos — Domicílios Coletivos Com Morador",
        "bar",
        (
            "Domicílios Coletivos Com Morador, Quantidade de crianças de zero a nove anos de idade",
        ),
    ),
    (
        "dpio_moradores_det",
        "Distribuição por Nº de Moradores — Domicílios Improvisados Ocupados",
        "bar",
        (
            "Domicílios Particulares Improvisados Ocupados, Com 1 morador no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 2 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 3 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 4 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 5 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 6 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 7 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 8 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 9 moradores no domicílio",
            "Domicílios Particulares Improvisados Ocupados, Com 10 ou mais moradores no domicílio",
        ),
    ),
    (
        "dccm_moradores_det",
        "Distribuição por Nº de Moradores — Domicílios Coletivos Com Morador",
        "bar",
        (
            "Domicílios Coletivos Com Morador, Com 1 morador no domicílio",
            "Domicílios Coletivos Com Morador, Com 2 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 3 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 4 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 5 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 6 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 7 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 8 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 9 moradores no domicílio",
            "Domicílios Coletivos Com Morador, Com 10 ou mais moradores no domicílio",
        ),
    ),
)
