"""Hand-made messages in the shapes real ones come in."""

from __future__ import annotations

import json


def demand(**changes) -> dict:
    message = {
        "materialDemandId": "0d6f2f0e-0000-4000-8000-000000000001",
        "materialNumberCustomer": "MC-1",
        "materialNumberSupplier": "MS-1",
        "materialDescriptionCustomer": "bolt",
        "materialGlobalAssetId": "urn:uuid:0d6f2f0e-0000-4000-8000-00000000000a",
        "customer": "BPNL00000001AAAA",
        "supplier": "BPNLSUPPLIER0001",
        "changedAt": "2025-07-01T12:00:00Z",
        "unitOfMeasure": "unit:piece",
        "unitOfMeasureIsOmitted": False,
        "materialDemandIsInactive": False,
        "demandSeries": [
            series("A1", ("2025-07-07", 742), ("2025-07-14", 1200.5)),
            series("B1", ("2025-07-21", 3), location="BPNS-2"),
        ],
    }
    message.update(changes)
    return {name: value for name, value in message.items() if value != "ABSENT"}


def series(code: str | None, *entries: tuple[str, float], location: str = "BPNS-1") -> dict:
    return {
        "customerLocation": location,
        "expectedSupplierLocation": "BPNS-9",
        "demandCategory": None if code is None else {"demandCategoryCode": code},
        "demands": [{"pointInTime": day, "demand": amount} for day, amount in entries],
    }


def threshold(number: int, deviation: float) -> dict:
    return {
        "sequenceNumber": number,
        "subhorizonLength": 4,
        "absoluteNegativeDeviation": deviation,
        "relativeNegativeDeviation": 0.25,
        "absolutePositiveDeviation": 23.0,
        "relativePositiveDeviation": 0.75,
    }


def linked(number: str, code: str) -> dict:
    return {
        "loadFactor": 1.25,
        "materialNumberCustomer": number,
        "materialNumberSupplier": "MS-1",
        "customerLocation": "BPNS-1",
        "demandCategory": {"demandCategoryCode": code},
    }


def capacity(**changes) -> dict:
    message = {
        "capacityGroupId": "cg-1",
        "name": "drilling",
        "supplier": "BPNL00000002BBBB",
        "customer": "BPNL00000001AAAA",
        "unitOfMeasure": "unit:piece",
        "changedAt": "2024-06-07T08:09:10Z",
        "unitOfMeasureIsOmitted": False,
        "capacityGroupIsInactive": True,
        "linkedCapacityGroups": ["cg-2", "cg-3"],
        "supplierLocations": ["BPNS-7"],
        "demandVolatilityParameters": {
            "measurementInterval": 4,
            "startReferenceDateTime": "2024-02-05T00:00:00Z",
            "rollingHorizonAlertThresholds": [threshold(1, 17.0), threshold(2, 19.5)],
        },
        "linkedDemandSeries": [linked("MC-1", "A1"), linked("MC-2", "B1")],
        "capacities": [
            {
                "pointInTime": f"2025-08-0{day}",
                "agreedCapacity": 310,
                "actualCapacity": 270 + day,
                "maximumCapacity": 355.5,
                "deltaProductionResult": 12,
            }
            for day in (1, 2, 3)
        ],
    }
    message.update(changes)
    return {name: value for name, value in message.items() if value != "ABSENT"}


def comment(**changes) -> dict:
    message = {
        "commentId": "11111111-2222-4333-8444-555555555555",
        "objectId": "urn:uuid:99999999-8888-4777-8666-555555555555",
        "objectType": "shipment",
        "customer": "BPNL10203040CU01",
        "supplier": "BPNL50607080SU02",
        "author": "someone@example.com",
        "postedAt": "2024-05-06T07:08:09Z",
        "changedAt": "2024-05-06T07:08:09Z",
        "commentText": "Hello",
        "commentType": "information",
        "requestDelete": True,
        "listOfReferenceDates": ["2024-09-02", "2024-09-09"],
    }
    message.update(changes)
    return {name: value for name, value in message.items() if value != "ABSENT"}


def messages(spark, topic: str, *documents):
    """A `(topic, value)` frame; documents are dicts, or texts taken as they are."""
    texts = [doc if doc is None or isinstance(doc, str) else json.dumps(doc) for doc in documents]
    return spark.createDataFrame([(topic, text) for text in texts], "topic string, value string")
