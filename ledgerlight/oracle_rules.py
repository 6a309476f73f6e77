"""Expected rule results as plain DuckDB SQL text, kept apart from the engine's rule tables.

Fixed values: the rule chains, ad-name layouts and canonical columns as the
oracles expect them. Nothing here is read from the engine, so a rule changed,
dropped or moved there turns its query red. ``{name}`` stands for an argument.
"""

from __future__ import annotations

# Marketing channel by campaign, medium and content; the first rule that holds wins.
CHANNEL = """CASE
  WHEN (((contains({campaign}, 'branding')) AND (contains({medium}, 'google / cpc'))) AND (NOT (contains({campaign}, 'Non-Branding') OR contains({campaign}, 'smartads') OR contains({campaign}, 'gdn') OR contains({campaign}, 'vídeo') OR contains({campaign}, 'display') OR contains({campaign}, 'youtube') OR contains({campaign}, 'inter')))) THEN 'GOOGLE_LP_BRANDING'
  WHEN ((contains({medium}, 'google / cpc')) AND (NOT (contains({campaign}, 'branding') OR contains({campaign}, 'smartads') OR contains({campaign}, 'gdn') OR contains({campaign}, 'vídeo') OR contains({campaign}, 'display') OR contains({campaign}, 'youtube')))) THEN 'GOOGLE_LP'
  WHEN ((contains({medium}, 'google / cpc')) AND (NOT (contains({campaign}, 'smartads') OR contains({campaign}, 'gdn') OR contains({campaign}, 'vídeo') OR contains({campaign}, 'display') OR contains({campaign}, 'youtube')))) THEN 'GOOGLE_LP'
  WHEN ((contains({medium}, 'google / cpc')) AND (contains({campaign}, 'gallery'))) THEN 'GOOGLE_ADS_GALLERY'
  WHEN (((contains({campaign}, 'smart-ads')) OR (contains({content}, 'smart-ads'))) AND (contains({medium}, 'google / cpc') OR contains({medium}, 'google-adwords / display') OR contains({medium}, 'google-ads-smart-ads / display'))) THEN 'SMARTADS_GOOGLE'
  WHEN (((contains({campaign}, 'gdn')) OR (contains({content}, 'gdn'))) AND (contains({medium}, 'google / cpc') OR contains({medium}, 'google-adwords / display') OR contains({medium}, 'google-ads-gdn / display') OR contains({medium}, 'google-gdn / display'))) THEN 'GOOGLE_GDN'
  WHEN (((contains({campaign}, 'discovery-ads')) OR (contains({content}, 'discovery-ads'))) AND (contains({medium}, 'google / cpc') OR contains({medium}, 'google-ads-discovery-ads / display') OR contains({medium}, 'google-adwords / display'))) THEN 'GOOGLE_DISCOVERY_ADS'
  WHEN (contains({medium}, 'bing / cpc')) THEN 'BING_LP'
  WHEN (contains({medium}, 'criteo / display')) THEN 'CRITEO'
  WHEN (contains({medium}, 'facebook / social')) THEN 'FACEBOOK'
  WHEN ((contains({medium}, 'kayak / comparador') OR contains({medium}, 'kayak / display') OR contains({medium}, 'kayak / core')) AND (contains({content}, 'metasearch') OR contains({content}, 'meta-search') OR contains({content}, 'cpa') OR contains({content}, 'core'))) THEN 'KAYAK_META_SEARCH'
  WHEN ((contains({medium}, 'kayak / comparador') OR contains({medium}, 'kayak / display')) AND (NOT (contains({content}, 'metasearch') OR contains({content}, 'meta-search') OR contains({content}, 'cpa')))) THEN 'KAYAK_DISPLAY'
  WHEN (contains({medium}, 'oath / display') OR contains({medium}, 'oath-brightroll / programatico')) THEN 'OATH_BRIGTHROLL'
  WHEN (contains({medium}, 'oath') OR contains({medium}, 'oath-gemini / native') OR contains({medium}, 'verizon-gemini / native')) THEN 'VERIZON_GEMINI'
  WHEN (contains({medium}, 'verizon-dsp / programatico') OR contains({medium}, 'verizon / display') OR contains({medium}, 'verizon-dsp / display')) THEN 'VERIZON_DSP'
  WHEN ((contains({medium}, 'skyscanner / comparador')) AND (contains({content}, 'meta-search') OR contains({content}, 'metasearch') OR contains({content}, 'core'))) THEN 'SKYSCANNER_META_SEARCH'
  WHEN ((contains({medium}, 'skyscanner / comparador') OR contains({medium}, 'skyscanner / display')) AND (NOT (contains({content}, 'meta-search') OR contains({content}, 'metasearch') OR contains({content}, 'core')))) THEN 'SKYSCANNER_DISPLAY'
  WHEN (contains({medium}, 'taboola / native') OR contains({medium}, 'taboola / display')) THEN 'TABOOLA'
  WHEN ((contains({medium}, 'viajala / comparador') OR contains({medium}, 'viajala / display')) AND (NOT (contains({content}, 'core')))) THEN 'VIAJALA_DISPLAY'
  WHEN ((contains({medium}, 'viajala / comparador') OR contains({medium}, 'viajala / core')) AND (contains({content}, 'core'))) THEN 'VIAJALA_META_SEARCH'
  WHEN ((contains({medium}, 'voopter / comparador') OR contains({medium}, 'voopter / core')) AND (contains({content}, 'meta') OR contains({content}, 'cpa') OR contains({content}, 'core'))) THEN 'VOOPTER_META_SEARCH'
  WHEN ((contains({medium}, 'voopter / comparador') OR contains({medium}, 'voopter / publi-editorial') OR contains({medium}, 'voopter / display')) AND (NOT (contains({content}, 'meta') OR contains({content}, 'cpa') OR contains({content}, 'core')))) THEN 'VOOPTER_DISPLAY'
  WHEN (contains({medium}, 'uol / display')) THEN 'UOL'
  WHEN (contains({medium}, 'abril / display')) THEN 'ABRIL'
  WHEN (contains({medium}, 'webedia / display')) THEN 'WEBEDIA'
  WHEN (contains({medium}, 'terra / display')) THEN 'TERRA'
  WHEN (contains({medium}, 'rtbhouse / native') OR contains({medium}, 'rtbhouse / display') OR contains({medium}, 'rtbhouse / programatico')) THEN 'RTBHOUSE'
  WHEN (contains({medium}, 'turismocity')) THEN 'TURSIMO_CITY_META_SEARCH'
  WHEN (contains({medium}, 'seedtag / display')) THEN 'SEEDTAG'
  WHEN (contains({medium}, 'outbrain / native') OR contains({medium}, 'outbrain / social')) THEN 'OUTBRAIN'
  WHEN (contains({medium}, 'xtmedia / display') OR contains({medium}, 'xtmedia / video')) THEN 'XTMEDIA'
  WHEN (contains({medium}, 'google / programatico') OR contains({medium}, 'google-dv360 / programatico') OR contains({medium}, 'google-dv360 / native') OR contains({medium}, 'google-dv360 / display')) THEN 'GOOGLE_DV360'
  WHEN (((contains({campaign}, 'gsp')) OR (contains({content}, 'gsp'))) AND (contains({medium}, 'google / cpc') OR contains({medium}, 'google-adwords / display') OR contains({medium}, 'google-ads-gsp / display'))) THEN 'GOOGLE_GSP'
  WHEN (contains({medium}, 'outlook / display') OR contains({medium}, 'oath / outlook') OR contains({medium}, 'oath-outlook / programatico')) THEN 'OUTLOOK_VERIZON'
  WHEN (contains({medium}, 'lancenet / display')) THEN 'LANCENET'
  WHEN (contains({medium}, 'folha / display')) THEN 'FOLHA'
  WHEN (contains({medium}, 'spotify / audio') OR contains({medium}, 'spotify / programatico') OR contains({medium}, 'spotify / display')) THEN 'SPOTIFY'
  WHEN (contains({medium}, 'google-dv360 / video') OR contains({medium}, 'google-dv360-youtube / programatico')) THEN 'YOUTUBE_DV360'
  WHEN (contains({medium}, 'jovem-nerd / content')) THEN 'JOVEM_NERD'
  WHEN (contains({medium}, 'brazil-journal / display')) THEN 'BRAZIL_JOURNAL'
  WHEN (contains({medium}, 'kiaora-digital / display')) THEN 'KIAORA'
  ELSE 'OUTROS'
END"""

# Device classes of the two rule sets.
DEVICE_A = """CASE
  WHEN ({device} = 'DESKTOP' OR {device} = 'TABLET') THEN 'DESKTOP'
  WHEN ({device} = 'MOBILE') THEN 'MOBILE'
  ELSE 'CROSS_DEVICE'
END"""
DEVICE_B = """CASE
  WHEN ({device} = 'DESKTOP' OR {device} = 'TABLET') THEN 'DESKTOP'
  WHEN ({device} = 'SMARTPHONE' OR {device} = 'UNKNOWN') THEN 'MOBILE'
  ELSE 'CROSS_DEVICE'
END"""

# Advertisers of the two rule sets.
ADVERTISER_A = """CASE
  WHEN (contains({campaign}, 'VAREJO-NAC') OR contains({campaign}, 'ALP_MADRUGOL-NACIONAL') OR contains({campaign}, 'ALP_ACAO-FIM-DE-SEMANA')) THEN 'GOL'
  WHEN (contains({campaign}, 'VAREJO-INTER') OR contains({campaign}, 'ALP_MADRUGOL-INTERNACIONAL')) THEN 'GOL_INTERNACIONAL'
  WHEN (contains({campaign}, 'MARCA')) THEN 'GOL_MARCA'
  WHEN (contains({campaign}, 'RECEITAS-AUXILIARES')) THEN 'GOL_RA'
  WHEN (contains({campaign}, 'KLM-AF')) THEN 'GOL_KLM-AF'
  WHEN (contains({campaign}, 'VOEBIZ')) THEN 'GOL_VOEBIZ'
  WHEN (contains({campaign}, 'GOLLOG')) THEN 'GOL_LOG'
  ELSE 'OUTROS'
END"""
ADVERTISER_B = """CASE
  WHEN (contains({campaign}, 'VAREJO-NAC')) THEN 'GOL'
  WHEN (contains({campaign}, 'VAREJO-INTER')) THEN 'GOL_INTERNACIONAL'
  WHEN (contains({campaign}, 'MARCA')) THEN 'GOL_MARCA'
  WHEN (contains({campaign}, 'RECEITAS-AUXILIARES')) THEN 'GOL_RA'
  ELSE ''
END"""

# Pillars.
PILLAR = """CASE
  WHEN (contains({ad}, 'META-SEARCH') OR contains({ad}, 'METASAERCH') OR contains({ad}, 'CORE') OR contains({ad}, 'CPA')) THEN 'COMPARADOR'
  WHEN (contains({advertiser}, 'GOL_INTERNACIONAL')) THEN 'VAREJO_INTERNACIONAL'
  WHEN ({vehicle} = 'GOOGLE_LP_BRANDING') THEN 'TERMOS_DE_MARCA'
  WHEN (contains({initiative}, 'RECEITAS-AUXILIARES')) THEN 'RECEITAS_AUXILIARES'
  WHEN (contains({initiative}, 'TEST-AND-LEARN')) THEN 'TEST_AND_lEARN'
  WHEN (contains({ad}, 'AQUISICAO_')) THEN 'AQUISICAO'
  ELSE 'VAREJO_NACIONAL'
END"""

# Vehicles whose ad name is campaign and ad group.
PAIR_VEHICLES = ('GOOGLE_LP', 'GOOGLE_LP_BRANDING', 'GOOGLE_ADS_GALLERY', 'SMARTADS_GOOGLE', 'GOOGLE_GDN', 'GOOGLE_DISCOVERY_ADS', 'BING_LP', 'GOOGLE_GSP')

# Fields that an ad name decodes to.
FIELDS = ('NOM_CAMPANHA', 'NOM_ORIGEM', 'NOM_MIDIA', 'NOM_INICIATIVA', 'TIP_CANAL', 'TIP_COMPRA', 'TIP_ESTRATEGIA', 'TIP_FORMATO', 'NOM_CRIATIVO', 'NOM_SEGMENTACAO')

# Layout -> (token of each field, 0_1 for the first two joined; last split; underscores needed; exactly so many).
LAYOUTS = {
    'analytics_search': (('0_1', 2, 3, 3, 7, 6, 4, 8, 9, 5), 9, 9, True),
    'analytics_other': ((1, 2, 3, 4, 5, 6, 7, 8, 9, 10), 10, 10, True),
    'search_ads_short': ((1, 2, 3, 3, 7, 6, 4, 8, 5, 9), 10, 9, True),
    'search_ads_long': ((1, 2, 3, 4, 5, 6, 7, 8, 9, 10), 11, 10, True),
    'paid_search': ((1, 2, 3, 3, 7, 6, 4, 8, 5, 9), 10, 9, False),
    'social': (('0_1', 2, 3, 4, 5, 6, 7, 8, 9, 10), 11, 10, False),
    'retargeting': (('0_1', 2, 3, 4, 5, 6, 7, 8, 9, 10), 10, 10, False),
    'native': ((1, 2, 3, 4, 5, 6, 7, 8, 9, 10), 11, 10, False),
}

# Columns of the canonical table, in order.
CANONICAL = 'NOM_ORIGEM_DADOS DAT_REFERENCIA NOM_ANUNCIANTE NOM_SITE NOM_AD NOM_DISCIPLINA NOM_CAMPANHA NOM_CAMPANHA_LP NOM_ORIGEM NOM_MIDIA NOM_INICIATIVA TIP_CANAL TIP_COMPRA TIP_ESTRATEGIA TIP_FORMATO NOM_CRIATIVO NOM_SEGMENTACAO NOM_PILAR TIP_DEVICE QTD_IMPRESSOES QTD_CLIQUES QTD_VISITAS QTD_NOVOS_USUARIOS QTD_REJEICOES QTD_TEMPO_SESSAO QTD_PAGEVIEWS QTD_TRECHOS QTD_TRANSACOES VAL_VENDA VAL_INVESTIMENTO VAL_INVEST_DESEMBOLSADO QTD_BUSCAS QTD_VIEWS_PLAY QTD_VIEWS_25 QTD_VIEWS_50 QTD_VIEWS_75 QTD_VIEWS_100 VAL_GA_VENDAS QTD_GA_TRECHOS QTD_GA_TRANSACOES NOM_GRUPO_ANUNCIO NOM_PALAVRA_CHAVE HOR_REFERENCIA NOM_REGIAO QTD_ALCANCE QTD_IMPRESSOES_VISIVEIS QTD_IMPRESSOES_MENSURAVEIS NOM_DOMINIO_VEICULADO NOM_URL'.split()
