"""Records of three patients made up for these tests, expanded to FHIR resources."""

from __future__ import annotations


def concept(code, display=None, text=None):
    coding = {"system": "urn:test", "code": code}
    if display:
        coding["display"] = display
    result = {"coding": [coding]}
    if text:
        result["text"] = text
    return result


def patient(pid, first, middle, family, gender, born, **extra):
    return {
        "resourceType": "Patient", "id": pid, "active": True, "gender": gender,
        "birthDate": born,
        "name": [{"use": "official", "family": family, "given": [first, middle]}],
        "identifier": [
            {"use": "secondary", "system": "urn:ssn", "value": "S-1"},
            {"use": "official", "system": "http://hospital.example.org/mrn", "value": "M-" + pid},
        ],
        "telecom": [
            {"system": "phone", "value": "555-0100", "use": "home"},
            {"system": "email", "value": "a@example.org", "use": "home"},
        ],
        "address": [{"use": "home", "line": ["12 Quay Lane"], "city": "Harborview",
                     "state": "OR", "postalCode": "97000", "country": "US"}],
        "maritalStatus": concept("M"),
        "communication": [{"language": concept("fr")},
                          {"language": concept("en-US"), "preferred": True}],
        **extra,
    }


def encounter(eid, pid, kind, start, end, **extra):
    return {
        "resourceType": "Encounter", "id": eid, "status": "finished", "class": {"code": kind},
        "type": [concept("185349003", "Check up")],
        "subject": {"reference": f"Patient/{pid}"},
        "period": {"start": start, "end": end}, **extra,
    }


def condition(cid, pid, code, text, status, onset, abated=None, **extra):
    result = {
        "resourceType": "Condition", "id": cid, "clinicalStatus": concept(status),
        "verificationStatus": concept("confirmed"), "category": [concept("problem-list-item")],
        "code": concept(code, "Dx", text), "subject": {"reference": f"Patient/{pid}"},
        "onsetDateTime": onset, "recordedDate": onset, **extra,
    }
    if abated:
        result["abatementDateTime"] = abated
    return result


def observation(oid, pid, value=4.1, **extra):
    return {
        "resourceType": "Observation", "id": oid, "status": "final",
        "category": [concept("laboratory")], "code": concept("2823-3", "Potassium", "Serum K"),
        "subject": {"reference": f"Patient/{pid}"},
        "encounter": {"reference": "Encounter/e-1"},
        "effectiveDateTime": "2022-03-01T07:20:00Z",
        "valueQuantity": {"value": value, "unit": "mmol/L", "code": "mmol/L"},
        "interpretation": [concept("H")], "referenceRange": [{"text": "Normal: 3.5 to 5.1"}],
        **extra,
    }


def claim(cid, pid, kind, amount, created, start, end, **extra):
    money = {"value": amount, "currency": "USD"}
    return {
        "resourceType": "Claim", "id": cid, "status": "active", "type": concept(kind, kind.title()),
        "use": "claim", "patient": {"reference": f"Patient/{pid}"},
        "billablePeriod": {"start": start, "end": end}, "created": created,
        "item": [{"sequence": 1, "productOrService": concept("99213"), "net": money}],
        "total": money, **extra,
    }


_PEOPLE = [
    ("p-100", "Noor", "Selma", "Haddad", "female", "1990-01-30"),
    ("p-200", "Tomas", "Erik", "Lindqvist", "male", "1957-06-03"),
    ("p-300", "Grace", "Ife", "Okafor", "female", "2001-12-12"),
]
_VISITS = {
    "p-100": [("AMB", "2022-01-04T08:00:00Z", "2022-01-04T08:45:00Z"),
              ("IMP", "2022-02-11T10:00:00Z", "2022-02-14T10:00:00Z"),
              ("EMER", "2022-03-20T22:30:00Z", "2022-03-21T04:30:00Z")],
    "p-200": [("AMB", "2022-04-06T13:00:00Z", "2022-04-06T15:00:00Z"),
              ("IMP", "2022-05-01T06:00:00Z", "2022-05-03T18:00:00Z"),
              ("EMER", "2022-06-15T01:00:00Z", "2022-06-15T09:30:00Z")],
    "p-300": [("EMER", "2022-07-09T17:15:00Z", "2022-07-09T22:15:00Z"),
              ("AMB", "2022-08-19T11:00:00Z", "2022-08-19T11:30:00Z"),
              ("IMP", "2022-09-02T12:00:00Z", "2022-09-06T14:00:00Z")],
}
_DIAGNOSES = {
    "p-100": [("N18.4", "2011-05-09"), ("J45.20", "2014-10-02"), ("G43.1", "2016-03-17"),
              ("E10.9", "2009-08-21"), ("H66.90", "2022-02-11", "2022-02-25")],
    "p-200": [("I25.10", "2012-01-30"), ("J44.9", "2017-11-11"), ("I11.0", "2008-04-04"),
              ("M05.79", "2019-06-25"), ("S52.50", "2022-05-01", "2022-05-31")],
    "p-300": [("F33.0", "2021-02-02"), ("L40.0", "2018-07-23"), ("I11.9", "2020-12-01"),
              ("E13.65", "2019-09-09"), ("N39.0", "2022-08-19", "2022-08-26")],
}
_BILLS = {
    "p-100": [("professional", 120.5, "2022-01-05", "2022-01-04", "2022-01-04"),
              ("institutional", 9100.0, "2022-02-20", "2022-02-11", "2022-02-14")],
    "p-200": [("professional", 310.0, "2022-04-08", "2022-04-06", "2022-04-06"),
              ("institutional", 2750.0, "2022-05-10", "2022-05-01", "2022-05-03")],
    "p-300": [("professional", 95.5, "2022-08-21", "2022-08-19", "2022-08-19"),
              ("institutional", 5400.0, "2022-09-15", "2022-09-02", "2022-09-06")],
}


def record(pid):
    """All resources of one patient: 19 of them."""
    person = next(p for p in _PEOPLE if p[0] == pid)
    rows = [patient(*person)]
    rows += [encounter(f"e-{pid}-{i}", pid, *v) for i, v in enumerate(_VISITS[pid])]
    for i, (code, onset, *end) in enumerate(_DIAGNOSES[pid]):
        status = "resolved" if end else "active"
        rows.append(condition(f"c-{pid}-{i}", pid, code, f"Text {code}", status, onset, *end))
    rows += [observation(f"o-{pid}-{i}", pid) for i in range(8)]
    rows += [claim(f"cl-{pid}-{i}", pid, *b) for i, b in enumerate(_BILLS[pid])]
    return rows


def everyone():
    return [r for person in _PEOPLE for r in record(person[0])]


def bundle(bid, resources):
    return {
        "resourceType": "Bundle", "id": bid, "type": "collection",
        "entry": [{"fullUrl": f"urn:uuid:{r['id']}", "resource": r} for r in resources],
    }
