"""Verbs of change in sentences of the kinds that decrees use."""

from __future__ import annotations

import pytest

from consolida.operators.tagging import verbs

REPLACED = [
    ("La première phrase de l'article 7.2 de l'arrêté du 3 mai 2011 est\n\n   remplacée   par la disposition suivante :", "remplacée"),
    ("L'article 3.1 de l'arrêté du 4 juin 2013 est remplacé par l'article suivant :", "remplacé"),
    ("L'article 3.1 de l'arrêté du 4 juin 2013 est remplacé par l’article suivant :", "remplacé"),
    ("L'article 3.1 est remplacé par l'alinéa suivant :", "remplacé"),
    ("L'article 3.1 est remplacé par l'expression suivante :", "remplacé"),
    ("L'article 3.1 est remplacé par l' article suivant :", "remplacé"),
    ("L'article 3.1 est modifié par celles de l'article 9 :", "modifié"),
    ("sont remplacées comme suit :", "remplacées"),
    ("Le troisième alinéa de l'article 5.2 est supprimé. Il est substitué par les alinéas suivants :", "substitué"),
    ("Les valeurs suivantes sont annulées et remplacées par celles du présent arrêté :", "annulées et remplacées"),
    ("Les prescriptions de cet article sont abrogées et remplacées par celles ci-après :", "abrogées et remplacées"),
    ("L' article 2 .3 .1 NATURE DES ACTIVITÉS est supprimé et remplacé par :", "supprimé et remplacé"),
    ("3 .1 .4 L' article 12 .1 de l' arrêté du 9 avril 2001 est modifié et remplacé par les dispositions suivantes :", "modifié et remplacé"),
    ("L'article 6 des prescriptions annexées à l'arrêté du 7 juillet 2007 est modifié et complété par les dispositions suivantes :", "modifié et complété"),
    ("Les dispositions de l'arrêté n12-001 sont modifiées, complétées, ou annulées par les dispositions fixées aux articles suivants :", "modifiées, complétées, ou annulées"),
    ("Le tableau de l'article 4 est ainsi modifié :", "modifié"),
    ("Les dispositions de l'article 3.9 - Bruit sont supprimées et sont remplacées par celles du tableau suivant :", "supprimées et sont remplacées"),
    ("Le tableau de l'article 2.2 de l'arrêté du 1er mars 2009 est mis à jour de la façon suivante :", "mis à jour"),
    ("L'article 8 est ainsi rédigé :", "rédigé"),
]
ADDED = [
    ("Le paragraphe 3.12 - Quais est complété comme suit :", "complété"),
    ("Le paragraphe 3.17.2 - Réseau d'eau est complété ainsi", "complété"),
    ("Les prescriptions de l' article 7.1. combustion de l' arrêté du 2 mars 2014 sont complétés d' articles 7.1 .5 et 7.1 .6 ainsi rédigés :", "complétés"),
    ("Il est créé un article 3.2.9 à l'arrêté du 5 mai 2005", "créé"),
    ("Un article additionnel 7.1.4 relatif au casier est créé en fin de chapitre 7.1 de l' arrêté du 6 juin 2016", "créé"),
    ("Il est créé un nouveau chapitre 9.3 à l' arrêté du 8 août 2008 rédigé comme suit :", "créé"),
    ("Sous le tableau des activités, il est créé deux nouveaux articles ainsi rédigés :", "créé"),
    ("Paragraphe 3.21 -Cuves. Il est ajouté un paragraphe rédigé ainsi:", "ajouté"),
    ("L' article 7 .4 suivant est ajouté à l'arrêté", "ajouté"),
    ("Le chapitre 5.3 relatif aux déchets de l'arrêté du 9 septembre 2009 est modifié par l'ajout du paragraphe", "modifié par l'ajout"),
    ("3.1.2 Le paragraphe suivant est inséré au début de l' article 12.1", "inséré"),
    ("A la suite du 2ème  alinéa de l' article 11.3 de l' arrêté du 1er avril 2004 sont insérées les dispositions suivantes :", "insérées"),
    ("Après le 3ème alinéa de l'article 3.2.6, il est inséré le nouvel alinéa suivant :", "inséré"),
    ("Après le 5ème alinéa de l'article 3.2.6, il est inséré les deux nouveaux alinéas suivants :", "inséré"),
    ("Un article numéroté 6.5.4.2. est inséré à la suite de l' article 6.5.4.1. de l' arrêté du 7 mars 2011 et est ainsi rédigée", "inséré"),
    ("Un article numéroté 10.3.2. intitulé Atelier est insérée dans le chapitre 10.3.", "insérée"),
    ("un article numéroté 9.2.3. est inséré et est ainsi rédigé :", "inséré"),
    ("Un titre 12, intitulé Dispositions particulières est inséré après le titre 11", "inséré"),
]
REMOVED = [
    ("Le premier alinéa de l' article 2 .1 .3 de l'arrêté précité est abrogé.", "abrogé"),
    ("L' article 9.3.1 relatif au bassin n° 2 vers le n° 3 est supprimé", "supprimé"),
    ("L' article 3.11  Arrêté type  des prescriptions annexées à l' arrêté modifié du 3 mars 2003 est annulé.", "annulé"),
    ("L'article 4 est retiré.", "retiré"),
]
AHEAD = [
    ("Le présent arrêté annule et remplace l'arrêté complémentaire du 2 février 2012 .", "replace", "annule et remplace", False),
    ("Le présent arrêté modifie et complète l'arrêté du 3 mars 2003 et l'arrêté du 4 avril 2004.", "replace", "modifie et complète", False),
    ("Le présent article abroge et remplace les articles suivants des chapitres 3.2 et 7.1 par les articles suivants .", "replace", "abroge et remplace", True),
    ("Sont insérés après le paragraphe 3.20 – clôture, les paragraphes suivants :", "add", "insérés", True),
    ("Le présent arrêté abroge l'arrêté du 5 mai 2005.", "delete", "abroge", False),
]


@pytest.mark.parametrize(("text", "kind", "keyword"), [(t, kind, k) for kind, cases in (("replace", REPLACED), ("add", ADDED), ("delete", REMOVED)) for t, k in cases])
def test_behind_their_references(text, kind, keyword):
    assert [(v.kind, v.direction, v.keyword, v.content) for v in verbs(text)] == [(kind, "rtl", keyword, kind != "delete")]


@pytest.mark.parametrize(("text", "kind", "keyword", "content"), AHEAD)
def test_ahead_of_their_references(text, kind, keyword, content):
    assert [(v.kind, v.direction, v.keyword, v.content) for v in verbs(text)] == [(kind, "ltr", keyword, content)]


@pytest.mark.parametrize(
    "text", ["", "L'exploitant est tenu de respecter l'article 3.", "Un extrait est inséré au recueil des actes administratifs.", "Les prescriptions remplacent celles de l'arrêté.", "Le présent arrêté complète utilement le dossier.", "est", "et sont , ou"]
)
def test_no_change(text):
    assert verbs(text) == []


def test_several_changes():
    found = verbs("L'article 1 est abrogé. L'article 2 est remplacé par : x ; l'article 3 est complété comme suit :")
    assert [(v.kind, v.keyword) for v in found] == [("delete", "abrogé"), ("replace", "remplacé"), ("add", "complété")]
