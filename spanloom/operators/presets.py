"""Ready-made wide mappings of the three signals."""

from __future__ import annotations


def text(*sources: str) -> dict:
    return {"sources": list(sources), "cast": "string"}


def shared(own: str) -> dict:
    """Columns that all three tables have; ``own`` is the signal's attribute selector."""
    env = [f'{at}["{key}"]' for at in ("resource.attributes", own) for key in ("deployment.environment.name", "deployment.environment", "env")]
    resource = lambda key: text(f'resource.attributes["{key}"]')
    return {
        "schema_version": {"value": "v1"},
        "env": {"sources": env, "default": "default", "cast": "string"},
        "row_id": "record.id",
        "service": resource("service.name"),
        "version": resource("service.version"),
        "instance_id": resource("service.instance.id"),
        "k8s_pod": resource("k8s.pod.name"),
        "k8s_namespace": resource("k8s.namespace.name"),
        "k8s_cluster": resource("k8s.cluster.name"),
        "container_name": resource("container.name"),
        "host": resource("host.name"),
        "host_ip": text('resource.attributes["host.ip"][0]', 'resource.attributes["host.ip"]'),
        "record": "record",
    }


def attributes(own: str, *keys: str) -> dict:
    return text(*(f'{own}["{key}"]' for key in keys))


LOG, SPAN = "log.attributes", "span.attributes"
LOGS_V1 = shared(LOG) | {
    "record_timestamp": "log.timestamp",
    "observed_timestamp": "log.observed_timestamp",
    "trace_id": "log.trace_id",
    "span_id": "log.span_id",
    "status": "log.severity_text",
    "severity_number": "log.severity_number",
    "message": "log.message",
    "source": text(*(f'{LOG}["{key}"]' for key in ("source", "event.source", "log.source")), 'resource.attributes["telemetry.sdk.language"]', 'resource.attributes["telemetry.sdk.name"]', "scope.name"),
    "exception_type": attributes(LOG, "exception.type"),
    "exception_message": attributes(LOG, "exception.message"),
}
TRACES_V1 = shared(SPAN) | {
    "start_timestamp": "span.start_time",
    "end_timestamp": "span.end_time",
    "duration_ns": "span.duration_ns",
    "trace_id": "span.trace_id",
    "span_id": "span.span_id",
    "parent_span_id": "span.parent_span_id",
    "span_name": "span.name",
    "span_kind": "span.kind",
    "status_code": "span.status.code",
    "http_method": attributes(SPAN, "http.request.method", "http.method"),
    "http_status_code": attributes(SPAN, "http.response.status_code", "http.status_code") | {"cast": "int"},
    "url_path": attributes(SPAN, "url.path", "http.target"),
    "http_route": attributes(SPAN, "http.route"),
    "peer_service": attributes(SPAN, "peer.service", "server.address", "net.peer.name"),
    "db_system": attributes(SPAN, "db.system.name", "db.system"),
    "db_operation": attributes(SPAN, "db.operation.name", "db.operation"),
    "rpc_method": attributes(SPAN, "rpc.method"),
    "error_type": attributes(SPAN, "error.type"),
}
METRICS_V1 = shared("datapoint.attributes") | {
    "record_timestamp": "datapoint.timestamp",
    "start_timestamp": "datapoint.start_time",
    "metric_name": "metric.name",
    "metric_type": "metric.type",
    "temporality": "metric.temporality",
    "unit": "metric.unit",
    "number_value": "datapoint.number_value",
    "distribution": "datapoint.distribution",
}
PRESETS = {"logs": LOGS_V1, "traces": TRACES_V1, "metrics": METRICS_V1}
