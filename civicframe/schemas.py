"""Fixed schemas of the council's objects; JSON is read with them, never inferred."""

from __future__ import annotations

FILE = "struct<id:string,name:string,accessUrl:string,mimeType:string,fileName:string,size:int,date:string,deleted:boolean>"
PERSON = "struct<id:string,name:string>"
CONSULTATION = "struct<id:string,paper:string,organization:array<string>,agendaItem:string,meeting:string,authoritative:boolean,role:string,deleted:boolean>"
PAPER = f"struct<id:string,type:string,name:string,reference:string,date:string,created:timestamp,modified:timestamp,paperType:string,mainFile:{FILE},auxiliaryFile:array<{FILE}>,file:array<{FILE}>,consultation:array<{CONSULTATION}>,body:string,deleted:boolean>"
ITEM = "struct<id:string,number:string,name:string>"
MEETING = f"struct<id:string,type:string,name:string,meetingState:string,cancelled:boolean,deleted:boolean,start:timestamp,end:timestamp,location:struct<description:string>,organization:array<string>,agendaItem:array<{ITEM}>,modified:timestamp>"
ORGANIZATION = "struct<id:string,type:string,name:string,shortName:string,classification:string,membership:array<string>,location:struct<description:string>,modified:timestamp>"
BODY = "struct<id:string,name:string,shortName:string,paper:string,meeting:string,organization:string,person:string,legislativeTerm:array<struct<id:string,name:string,startDate:date,endDate:date>>>"
MENTION = "struct<pos:int,type:string,value:string,context:string,latitude:double,longitude:double>"
STATE = "resource_id string, resource_type string, status string, processed_at timestamp, seq long, metadata string, error_message string"
RUN = "run_id string, start_time timestamp, end_time timestamp, status string, city string, config string, stats string"
CHECKPOINT = "resource_type string, batch long, checkpoint_time timestamp, batch_size long, total_processed long, run_id string"
