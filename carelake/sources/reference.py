"""Small fixed reference tables."""

# Postcode prefix ranges (first, last, neighbourhood); where ranges
# overlap, the first listed holds.
POSTCODE_RANGES = (
    ("90010", "90050", "Centro Histórico"),
    ("90020", "90020", "Centro Histórico"),
    ("90035", "90050", "Centro Histórico"),
    ("90040", "90060", "Cidade Baixa"),
    ("90050", "90050", "Bom Fim"),
    ("90130", "90160", "Cidade Baixa"),
    ("90160", "90220", "Menino Deus"),
    ("90230", "90250", "Praia de Belas"),
    ("90250", "90260", "Azenha"),
    ("90260", "90290", "Santana"),
    ("90420", "90470", "Bom Fim"),
    ("90460", "90490", "Rio Branco"),
    ("90470", "90520", "Auxiliadora"),
    ("90510", "90520", "Moinhos de Vento"),
    ("90520", "90540", "Mont' Serrat"),
    ("90540", "90550", "Higienópolis"),
    ("90550", "90570", "São João"),
    ("90570", "90610", "Floresta"),
    ("90610", "90630", "Santa Cecília"),
    ("90619", "90619", "Farroupilha"),
    ("90630", "90650", "Petrópolis"),
    ("90650", "90670", "Jardim Botânico"),
    ("90670", "90680", "Vila Jardim"),
    ("90680", "90690", "Jardim do Salso"),
    ("90690", "90710", "Bela Vista"),
    ("90710", "90720", "Boa Vista"),
    ("90720", "90750", "Passo da Areia"),
    ("90750", "90780", "Cristo Redentor"),
    ("90780", "90810", "São Geraldo"),
    ("90810", "90830", "Navegantes"),
    ("90830", "90850", "Humaitá"),
    ("90850", "90870", "Anchieta"),
    ("90880", "90900", "Sarandi"),
    ("91010", "91040", "Sarandi"),
    ("91030", "91050", "Rubem Berta"),
    ("91050", "91110", "Mário Quintana"),
    ("91110", "91130", "Costa e Silva"),
    ("91130", "91170", "Jardim Itu-Sabará"),
    ("91170", "91220", "Jardim Lindóia"),
    ("91220", "91230", "Vila Ipiranga"),
    ("91230", "91240", "Jardim São Pedro"),
    ("91240", "91250", "Jardim Floresta"),
    ("91250", "91260", "Passo das Pedras"),
    ("91260", "91320", "Protásio Alves"),
    ("91320", "91340", "Vila Jardim"),
    ("91340", "91350", "Três Figueiras"),
    ("91350", "91360", "Chácara das Pedras"),
    ("91370", "91410", "Cristal"),
    ("91410", "91430", "Cavalhada"),
    ("91430", "91460", "Vila Nova"),
    ("91460", "91500", "Camaquã"),
    ("91500", "91520", "Espírito Santo"),
    ("91520", "91530", "Tristeza"),
    ("91530", "91540", "Vila Conceição"),
    ("91540", "91550", "Pedra Redonda"),
    ("91550", "91560", "Ipanema"),
    ("91560", "91710", "Restinga"),
    ("91710", "91720", "Lami"),
    ("91720", "91740", "Belém Novo"),
    ("91740", "91760", "Lageado"),
    ("91760", "91780", "Ponta Grossa"),
    ("91780", "91800", "Belém Velho"),
    ("91900", "91930", "Aberta dos Morros"),
    ("91930", "91940", "Jardim Isabel"),
    ("91940", "91960", "Vila Assunção"),
    ("91960", "91987", "Hípica"),
    ("92010", "92060", "Teresópolis"),
    ("92060", "92110", "Glória"),
    ("92110", "92170", "Medianeira"),
    ("92170", "92210", "Cascata"),
    ("92210", "92260", "Vila João Pessoa"),
    ("92260", "92310", "Partenon"),
    ("92310", "92360", "Cel. Aparício Borges"),
    ("92360", "92410", "São José"),
    ("92410", "92460", "Vila São José"),
    ("92460", "92510", "Santo Antônio"),
)
