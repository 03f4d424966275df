"""Fixed vocabularies: field names, label tables and message formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. Everything down to the matching line must keep exactly these
# names, codes and texts, because results are compared and joined on them.
# ---------------------------------------------------------------------------

EVENT_LOG_NAMESPACE = "http://schemas.microsoft.com/win/2004/08/events/event"

XML_FIELDS = {
    "SubjectUserName": "subject_user_name",
    "SubjectUserSid": "subject_user_sid",
    "SubjectDomainName": "subject_domain_name",
    "SubjectLogonId": "subject_logon_id",
    "TargetUserName": "target_user_name",
    "TargetUserSid": "target_user_sid",
    "TargetSid": "target_user_sid",
    "TargetDomainName": "target_domain_name",
    "LogonType": "logon_type",
    "TicketEncryptionType": "ticket_encryption_type",
    "TicketOptions": "ticket_options",
    "FailureReason": "failure_reason",
    "Status": "status",
    "SubStatus": "sub_status",
    "AuthenticationPackageName": "authentication_package",
    "IpAddress": "ip_address",
    "IpPort": "ip_port",
    "WorkstationName": "workstation_name",
    "ObjectName": "object_name",
    "ObjectType": "object_type",
    "ObjectServer": "object_server",
    "OperationType": "operation_type",
    "AccessMask": "access_mask",
    "Properties": "properties",
    "PrivilegeList": "privilege_list",
}

JSON_FIELDS = {name: column for name, column in XML_FIELDS.items() if name != "TargetSid"}

XML_EMPTY_MARKS = ("-", "%%1793")

SPARSE_COLUMNS = [
    "target_user_name", "target_user_sid", "target_domain_name", "logon_type",
    "ticket_encryption_type", "ticket_options", "failure_reason",
    "status", "sub_status", "authentication_package",
    "ip_address", "ip_port", "workstation_name",
    "object_name", "object_type", "object_server", "operation_type",
    "access_mask", "properties", "privilege_list",
    "subject_user_name", "subject_user_sid", "subject_domain_name",
    "subject_logon_id",
]

LEAKAGE_COLUMNS = [
    "computer", "hostname_raw", "source_dataset", "source_file",
    "record_id", "raw", "source_format",
]

TARGET_COLUMNS = ["label", "mitre_tactic", "mitre_technique"]

EMULATION_LABELS = [
    "dcsync_convenant",
    "dcsync_empire",
    "kerberos_createnetonly",
    "mimikatz",
    "ntds_dump_ninjacopy",
    "ntds_dump_ntdsutil",
    "ntds_dump_shadowcopy",
    "pass_the_hash",
]

# category, file, label, tactic, technique
MANIFEST = [
    ("credential_access", "CA_DCSync_4662.evtx", "dcsync", "TA0006", "T1003.006"),
    ("credential_access", "kerberos_pwd_spray_4771.evtx", "password_spraying", "TA0006", "T1110.003"),
    ("credential_access", "ACL_ForcePwd_SPNAdd_User_Computer_Accounts.evtx", "acl_abuse_spn_add", "TA0006", "T1222"),
    ("credential_access", "4794_DSRM_password_change_t1098.evtx", "dsrm_password_change", "TA0003", "T1098"),
    ("credential_access", "remote_pwd_reset_rpc_mimikatz_postzerologon_target_DC.evtx", "post_zerologon_password_reset", "TA0004", "T1098"),
    ("credential_access", "Zerologon_VoidSec_CVE-2020-1472_4626_LT3_Anonym_follwedby_4742_DC_Anony_DC.evtx", "zerologon", "TA0004", "CVE-2020-1472"),
    ("credential_access", "Sysmon13_MachineAccount_Password_Hash_Changed_via_LsarSetSecret.evtx", "machine_account_hash_change", "TA0006", "T1098"),
    ("credential_access", "Sysmon_13_Local_Admin_Password_Changed.evtx", "local_admin_password_changed", "TA0003", "T1098"),
    ("discovery", "dicovery_4661_net_group_domain_admins_target.evtx", "domain_admins_enumeration", "TA0007", "T1069.002"),
    ("discovery", "discovery_bloodhound.evtx", "bloodhound_enumeration", "TA0007", "T1482"),
    ("discovery", "discovery_local_user_or_group_windows_security_4799_4798.evtx", "local_group_enumeration", "TA0007", "T1069.001"),
    ("discovery", "4799_remote_local_groups_enumeration.evtx", "remote_group_enumeration", "TA0007", "T1069.001"),
    ("discovery", "discovery_psloggedon.evtx", "logged_on_users_discovery", "TA0007", "T1033"),
    ("lateral_movement", "LM_4624_mimikatz_sekurlsa_pth_source_machine.evtx", "pass_the_hash", "TA0008", "T1550.002"),
    ("lateral_movement", "ImpersonateUser-via local Pass The Hash Sysmon and Security.evtx", "pass_the_hash", "TA0008", "T1550.002"),
    ("lateral_movement", "LM_WMI_4624_4688_TargetHost.evtx", "wmi_lateral_movement", "TA0008", "T1047"),
    ("lateral_movement", "remote task update 4624 4702 same logonid.evtx", "scheduled_task_lateral_movement", "TA0008", "T1053.005"),
    ("lateral_movement", "LM_PowershellRemoting_sysmon_1_wsmprovhost.evtx", "winrm_lateral_movement", "TA0008", "T1021.006"),
    ("lateral_movement", "LM_winrm_target_wrmlogs_91_wsmanShellStarted_poorLog.evtx", "winrm_lateral_movement", "TA0008", "T1021.006"),
    ("lateral_movement", "LM_ScheduledTask_ATSVC_target_host.evtx", "scheduled_task_lateral_movement", "TA0008", "T1053.002"),
    ("lateral_movement", "LM_Remote_Service01_5145_svcctl.evtx", "remote_service_lateral_movement", "TA0008", "T1021.002"),
    ("lateral_movement", "LM_REMCOM_5145_TargetHost.evtx", "psexec_like_lateral_movement", "TA0008", "T1021.002"),
    ("lateral_movement", "lm_sysmon_psexec_smb_meterpreter.evtx", "psexec_lateral_movement", "TA0008", "T1021.002"),
    ("persistence", "Network_Service_Guest_added_to_admins_4732.evtx", "privileged_group_membership_abuse", "TA0003", "T1098"),
    ("persistence", "DACL_DCSync_Right_Powerview_ Add-DomainObjectAcl.evtx", "acl_abuse_dcsync_right", "TA0003", "T1098"),
    ("persistence", "persistence_security_dcshadow_4742.evtx", "dcshadow", "TA0003", "T1207"),
    ("persistence", "persistence_hidden_local_account_sysmon.evtx", "hidden_account_creation", "TA0003", "T1136.001"),
    ("persistence", "persist_valid_account_guest_rid_hijack.evtx", "rid_hijacking", "TA0003", "T1098"),
    ("persistence", "sysmon_local_account_creation_and_added_admingroup_12_13.evtx", "account_creation_admin_group", "TA0003", "T1136.001"),
    ("persistence", "persistence_pendingGPO_sysmon_13.evtx", "gpo_modification", "TA0003", "T1484.001"),
    ("privilege_escalation", "4765_sidhistory_add_t1178.evtx", "sid_history_injection", "TA0004", "T1134.005"),
    ("privilege_escalation", "samaccount_spoofing_CVE-2021-42287_CVE-2021-42278_DC_securitylogs.evtx", "nopac_samaccountname_spoofing", "TA0004", "CVE-2021-42287"),
    ("privilege_escalation", "privexchange_dirkjan.evtx", "privexchange", "TA0004", "T1187"),
]

# label, tactic, technique: used where the source carries no manifest entry
MANUAL_MITRE = [
    ("dcsync_convenant", "TA0006", "T1003.006"),
    ("dcsync_empire", "TA0006", "T1003.006"),
    ("mimikatz", "TA0006", "T1003.001"),
    ("kerberos_createnetonly", "TA0008", "T1550.003"),
    ("ntds_dump_ninjacopy", "TA0006", "T1003.003"),
    ("ntds_dump_ntdsutil", "TA0006", "T1003.003"),
    ("ntds_dump_shadowcopy", "TA0006", "T1003.003"),
]

TACTIC_NAMES = {
    "TA0003": "Persistence",
    "TA0004": "Privilege Escalation",
    "TA0006": "Credential Access",
    "TA0007": "Discovery",
    "TA0008": "Lateral Movement",
}

LABEL_TECHNIQUES = {
    "dcsync": "T1003.006",
    "dcsync_convenant": "T1003.006",
    "dcsync_empire": "T1003.006",
    "mimikatz": "T1003.001",
    "ntds_dump_ninjacopy": "T1003.003",
    "ntds_dump_ntdsutil": "T1003.003",
    "ntds_dump_shadowcopy": "T1003.003",
    "kerberos_createnetonly": "T1550.003",
    "pass_the_hash": "T1550.002",
    "password_spraying": "T1110.003",
    "acl_abuse_spn_add": "T1222",
    "acl_abuse_dcsync_right": "T1098",
    "account_creation_admin_group": "T1136.001",
    "dcshadow": "T1207",
    "zerologon": "CVE-2020-1472",
    "nopac_samaccountname_spoofing": "CVE-2021-42287",
    "privexchange": "T1187",
    "bloodhound_enumeration": "T1482",
    "domain_admins_enumeration": "T1069.002",
    "local_group_enumeration": "T1069.001",
    "remote_group_enumeration": "T1069.001",
    "logged_on_users_discovery": "T1033",
    "gpo_modification": "T1484.001",
    "hidden_account_creation": "T1136.001",
    "rid_hijacking": "T1098",
    "sid_history_injection": "T1134.005",
    "machine_account_hash_change": "T1098",
    "local_admin_password_changed": "T1098",
    "privileged_group_membership_abuse": "T1098",
    "psexec_lateral_movement": "T1021.002",
    "psexec_like_lateral_movement": "T1021.002",
    "remote_service_lateral_movement": "T1021.002",
    "scheduled_task_lateral_movement": "T1053.005",
    "winrm_lateral_movement": "T1021.006",
    "wmi_lateral_movement": "T1047",
    "dsrm_password_change": "T1098",
    "post_zerologon_password_reset": "T1098",
}

LABEL_DESCRIPTIONS = {
    "dcsync": "Replication DCSync: extraction of password hashes via the AD replication protocol",
    "dcsync_convenant": "DCSync executed through the Covenant C2 framework",
    "dcsync_empire": "DCSync executed through the Empire C2 framework",
    "mimikatz": "In-memory credential extraction via Mimikatz (LSASS)",
    "ntds_dump_ninjacopy": "NTDS.dit extraction via NinjaCopy",
    "ntds_dump_ntdsutil": "NTDS.dit extraction via ntdsutil",
    "ntds_dump_shadowcopy": "NTDS.dit extraction via Volume Shadow Copy",
    "kerberos_createnetonly": "Sacrificial Kerberos session (Rubeus createnetonly), often a precursor to Pass-the-Ticket",
    "pass_the_hash": "Authentication using a stolen NTLM hash (Pass-the-Hash)",
    "password_spraying": "Low-and-slow authentication attempts against many accounts to avoid lockouts",
    "acl_abuse_spn_add": "Abuse of AD ACL rights to add a Service Principal Name for Kerberoasting",
    "acl_abuse_dcsync_right": "Abuse of AD ACL rights to grant DCSync replication permissions",
    "account_creation_admin_group": "Creation of an account and addition to a privileged group",
    "dcshadow": "Rogue domain controller registration to push unauthorized directory changes",
    "zerologon": "Exploitation of CVE-2020-1472 to reset the domain controller machine account password",
    "nopac_samaccountname_spoofing": "Exploitation of CVE-2021-42287/42278 via SAM account name spoofing",
    "privexchange": "Abuse of Exchange privileges to escalate to Domain Admin",
    "bloodhound_enumeration": "AD relationship enumeration via BloodHound for attack path discovery",
    "domain_admins_enumeration": "Enumeration of the Domain Admins group membership",
    "local_group_enumeration": "Enumeration of local group membership",
    "remote_group_enumeration": "Remote enumeration of group membership",
    "logged_on_users_discovery": "Discovery of currently logged-on users on a host",
    "gpo_modification": "Modification of a Group Policy Object",
    "hidden_account_creation": "Creation of a hidden local account",
    "rid_hijacking": "RID hijacking to grant administrative privileges to a low-privilege account",
    "sid_history_injection": "Injection of a privileged SID into the SID history attribute",
    "machine_account_hash_change": "Unexpected machine account password/hash change",
    "local_admin_password_changed": "Local administrator password change",
    "privileged_group_membership_abuse": "Unauthorized addition of an account to a privileged group",
    "psexec_lateral_movement": "Lateral movement via PsExec-style remote service execution",
    "psexec_like_lateral_movement": "Lateral movement via a PsExec-like remote execution tool",
    "remote_service_lateral_movement": "Lateral movement via remote service creation",
    "scheduled_task_lateral_movement": "Lateral movement via remote scheduled task creation",
    "winrm_lateral_movement": "Lateral movement via WinRM/PowerShell remoting",
    "wmi_lateral_movement": "Lateral movement via WMI remote execution",
    "dsrm_password_change": "Directory Services Restore Mode password change",
    "post_zerologon_password_reset": "Password reset performed following a Zerologon exploitation",
    "benign": "Normal authentication or directory activity consistent with baseline behavior",
}

UNKNOWN_DESCRIPTION = "Unknown technique"

LABEL_ACTIONS = {
    "pass_the_hash": ["Reset credentials for the affected account", "Review logons from the source workstation (last 24h)", "Check for lateral connections to other hosts"],
    "mimikatz": ["Isolate the affected host from the network", "Rotate credentials for all recent logons on the host", "Capture a memory image before remediation"],
    "dcsync_empire": ["Audit DS-Replication-Get-Changes grantees", "Reset the KRBTGT password (twice, 24h apart)", "Review Empire C2 indicators across the domain"],
    "dcsync_convenant": ["Reset the KRBTGT password (twice, 24h apart)", "Audit replication permissions domain-wide", "Hunt for Covenant C2 beacon patterns"],
    "dcsync": ["Audit DS-Replication-Get-Changes grantees", "Reset the KRBTGT password (twice, 24h apart)"],
    "kerberos_createnetonly": ["Correlate the logon ID across subsequent events", "Check for Rubeus artifacts on the source host", "Flag the ticket for Pass-the-Ticket follow-up"],
    "ntds_dump_shadowcopy": ["Escalate to full incident response", "Isolate the domain controller immediately", "Begin domain-wide credential rotation"],
    "ntds_dump_ninjacopy": ["Escalate to full incident response", "Isolate the domain controller immediately", "Begin domain-wide credential rotation"],
    "ntds_dump_ntdsutil": ["Escalate to full incident response", "Isolate the domain controller immediately", "Begin domain-wide credential rotation"],
    "zerologon": ["Patch CVE-2020-1472 immediately", "Reset the domain controller machine account password", "Audit for follow-on DCSync activity"],
    "nopac_samaccountname_spoofing": ["Patch CVE-2021-42287/42278", "Audit recently created machine accounts", "Review Domain Admin group membership"],
    "dcshadow": ["Identify and remove the rogue DC registration", "Audit recent directory replication changes", "Reset KRBTGT twice"],
    "bloodhound_enumeration": ["Identify the source workstation and account", "Review recent LDAP query volume from that host", "Audit exposed attack paths to Domain Admins"],
    "domain_admins_enumeration": ["Correlate with subsequent privilege escalation attempts", "Review source account's recent activity"],
    "password_spraying": ["Identify targeted accounts and lock down if needed", "Enable/verify account lockout policies", "Check source IP against threat intel"],
    "account_creation_admin_group": ["Verify the account creation was authorized", "Review who performed the group addition", "Disable the account if unauthorized"],
    "gpo_modification": ["Review the GPO change history", "Verify the modifying account's authorization", "Roll back if unauthorized"],
    "scheduled_task_lateral_movement": ["Review the scheduled task definition on the target host", "Correlate with the source account's other activity"],
    "wmi_lateral_movement": ["Review WMI event consumers on the target host", "Correlate with the source account's other activity"],
    "winrm_lateral_movement": ["Review PowerShell remoting logs on the target host", "Correlate with the source account's other activity"],
    "psexec_lateral_movement": ["Review the remote service created on the target host", "Correlate with the source account's other activity"],
    "psexec_like_lateral_movement": ["Review the remote service created on the target host", "Correlate with the source account's other activity"],
    "benign": [],
}

PRIORITY_LABELS = [
    "pass_the_hash", "mimikatz", "dcsync_empire", "dcsync_convenant",
    "kerberos_createnetonly", "ntds_dump_shadowcopy", "benign",
]

DESCRIBED_LABELS = [
    "benign", "dcsync_empire", "pass_the_hash", "mimikatz",
    "kerberos_createnetonly", "dcsync_convenant",
]


DISPLAY_FIELDS = [
    "event_id", "subject_user_name", "subject_domain_name", "subject_user_sid",
    "target_user_name", "target_domain_name", "logon_type",
    "ticket_encryption_type", "authentication_package",
    "object_name", "object_type", "access_mask", "properties",
    "computer",
]

BENIGN_TACTIC = "BENIGN"
BENIGN_LABEL = "benign"
UNKNOWN_LABEL = "UNKNOWN"
UNKNOWN_HOST = "UNKNOWN"
BALANCED_TACTIC = "TA0006"
XML_FORMAT = "evtx_xml"
JSON_FORMAT = "mordor_jsonl"
RARE_THRESHOLD = 5
TOP_EVENT_IDS = 20
WINDOW_SECONDS = 300
RELATED_LIMIT = 6

# Message formats; {name} stands for a column of the prediction row.
ANALYZE_PROMPT = (
    "You are a senior SOC analyst assistant specialized in Active Directory.\n"
    "A detection system flagged the following event:\n\n"
    "- Technique: {predicted_label}\n"
    "- Description: {description}\n"
    "- MITRE tactic: {predicted_tactic} ({tactic_name})\n"
    "- MITRE technique: {predicted_technique}\n"
    "- Stage 1 (tactic) confidence: {stage1}\n"
    "- Stage 2 (technique) confidence: {stage2}\n\n"
    "Write a short analyst-facing explanation in English (4-5 sentences):\n"
    "1. What this technique concretely means\n"
    "2. Why it matters in an Active Directory environment\n"
    "3. A concrete first triage action\n"
)
REPORT_PROMPT = (
    "Tu es un analyste SOC senior specialise en Active Directory.\n"
    "Un systeme de detection a identifie l'evenement suivant :\n\n"
    "- Technique detectee : {predicted_label}\n"
    "- Description : {description}\n"
    "- Tactique MITRE ATT&CK : {predicted_tactic} ({tactic_name})\n"
    "- Technique MITRE ATT&CK : {predicted_technique}\n"
    "- Confiance stage 1 (tactique) : {stage1}\n"
    "- Confiance stage 2 (technique) : {stage2}\n\n"
    "Redige en francais une explication courte (4-5 phrases) pour un analyste SOC :\n"
    "1. Ce que represente cette technique concretement\n"
    "2. Pourquoi elle est dangereuse dans un environnement Active Directory\n"
    "3. Une premiere action de triage recommandee\n"
)
ASK_PROMPT_HEAD = (
    "You are a senior SOC analyst assistant specialized in Active Directory. "
    "An analyst is reviewing this detection:\n"
    "- Technique: {predicted_label}\n"
    "- MITRE tactic: {predicted_tactic}\n"
    "- MITRE technique: {predicted_technique}\n"
)
ASK_PROMPT_STAGE1 = "- Stage 1 confidence: {stage1}\n"
ASK_PROMPT_STAGE2 = "- Stage 2 confidence: {stage2}\n"
ASK_PROMPT_TAIL = (
    "\nThe analyst asks: \"{question}\"\n\n"
    "Answer concisely (2-4 sentences), in English, as a SOC assistant would."
)
PLAIN_PROSE_SUFFIX = (
    "\n\nDo not use markdown formatting: no asterisks, no bullet points, no headers. "
    "Write in plain conversational prose only."
)
BENIGN_EXPLANATION = "Event classified as normal activity (benign). No further analysis required."
BENIGN_REPORT_EXPLANATION = "Evenement classe comme activite normale (benign)."
REPORT_FORMAT = (
    "=== RAPPORT SOC ===\n"
    "Severite       : {severity}\n"
    "Technique      : {predicted_label}\n"
    "Tactique MITRE : {predicted_tactic} ({tactic_name})\n"
    "Technique MITRE: {predicted_technique}\n"
    "Confiance      : stage1={stage1}, stage2={stage2}\n\n"
    "Explication analyste :\n"
    "{explanation}\n"
)

# ---------------------------------------------------------------------------
# End of the fixed values.
# ---------------------------------------------------------------------------


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def manifest_table(spark: SparkSession, entries=None) -> DataFrame:
    """The manifest as a table; `file_rank` keeps the order of the entries."""
    rows = [(i, *entry) for i, entry in enumerate(MANIFEST if entries is None else entries)]
    return spark.createDataFrame(
        rows, "file_rank int, category string, file string, label string, tactic string, technique string"
    )


def manual_mitre_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MANUAL_MITRE, _strings("label", "manual_tactic", "manual_technique"))


def tactic_name_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TACTIC_NAMES.items()), _strings("predicted_tactic", "tactic_name"))


def technique_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LABEL_TECHNIQUES.items()), _strings("predicted_label", "predicted_technique")
    )


def description_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LABEL_DESCRIPTIONS.items()), _strings("predicted_label", "known_description")
    )


def action_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(LABEL_ACTIONS.items()), "predicted_label string, known_actions array<string>"
    )
